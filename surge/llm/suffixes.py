"""Suffix-array dedup: every byte of a string of ``length`` bytes that starts anywhere else, found by deep-shallow sorting.

Sparse suffixes.  The anchor of a ``length``-byte string is the position of its least 16-byte gram
hash among its first ``reach`` positions, so equal strings have anchors at equal offsets.  Suffixes
are sorted at anchors only, one in some ``reach`` / 2 bytes.  An anchor stands for the strings that
share it; its context are their bytes, its core the bytes that all of them hold.

Groups.  Equal strings have equal cores, so anchors meet by a hash of the core.  Where all contexts
of a core are equal, or a context occurs again, all its strings are repeated (contexts are compared
by 64 bits of hash within 64 bits of core hash).  The distinct contexts of a core are few, around
the ends of repeated passages; they are sorted.

Deep-shallow sorting.  Multikey quicksort orders the suffixes of many groups to a shallow depth;
groups that are still equal there have long common prefixes and are ordered by blind tries, which
keep only the branching bytes and compare a suffix with one leaf.  The text left of the anchors is
sorted alike.  A string that starts d bytes left of its anchor is repeated when another context
shares ``length`` - d bytes in the one order and d bytes in the other: both are runs of the common
prefixes of neighbours, so no pairs are made.

A core with more than ``LIMIT`` distinct contexts is dealt by longer cores, each for a part of the
offsets, until its groups are small or hold one string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surge.llm.batches import _BYTE_CODES, SLICE_BYTES, _powers, mix64, slices
from surge.llm.staging import release, staged

GRAM = 16
#: Bytes up to which suffixes are ordered by multikey quicksort.
SHALLOW = 64
#: Distinct contexts of a core that one task sorts at once.
LIMIT = 4096
#: Parts into which the offsets of a larger group are dealt.
SPLIT = 8
#: Parts into which the rows of every core are dealt when they meet their core's result.
SALTS = 8
#: Rows of a task's sort: whole groups, as many as fit.
BATCH = 8192
_GEAR = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
WHO = ["doc", "dig"]


def reach_of(length: int) -> int:
    """Positions among which the anchor of a string is chosen."""
    if not 64 <= length <= 4096:
        raise ValueError("length must lie between 64 and 4096 bytes")
    return length // 4 + 4


class Hashes:
    """Hashes of any piece of a byte array."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODES[data] * up[:len(data)], out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.total[end] - self.total[start]) * self.down[start])


def anchors(data: np.ndarray, offs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first, last): for every anchor the first and last start of the strings that share it (byte positions).

    ``offs`` are the borders of documents; strings do not cross them.
    """
    reach, n = reach_of(length), len(data)
    if n < length:
        return (np.zeros(0, dtype=np.int64),) * 3
    h = _GEAR[data]
    for step in (1, 2, 4, 8):
        h[:-step] = h[:-step] + (h[step:] * np.uint64(0x9E3779B97F4A7C15 ** step & (1 << 64) - 1))
    key = (mix64(h) & ~np.uint64(0xFFFFFFFF)) | np.arange(n, dtype=np.uint64)  # the earlier of equal grams
    low, width = key, 1
    while 2 * width <= reach:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:n - reach + 1], low[reach - width:])
    end = np.repeat(offs[1:], np.diff(offs))[:len(low)]
    start = np.flatnonzero(np.arange(len(low)) + length <= end)
    at = (low[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(start, prepend=-2) != 1))
    last = np.concatenate([new[1:] - 1, [len(start) - 1]]) if len(new) else new
    return at[new], start[new], start[last]


def _pieces(column: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, borders, document of each part, its place in the document): documents whole, or cut so that every string is in one part."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if offs[-1] - offs[0] <= 2 * SLICE_BYTES:
        yield data[offs[0]:offs[-1]], offs - offs[0], np.arange(len(column)), np.zeros(len(column), np.int64)
        return
    for d in range(len(column)):  # a long document
        for at in range(0, int(offs[d + 1] - offs[d]), SLICE_BYTES):
            part = data[offs[d] + at:min(offs[d] + at + SLICE_BYTES + length - 1, offs[d + 1])]
            yield part, np.array([0, len(part)]), np.array([d]), np.array([at])


def anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    """(doc, dig, at, low, high, core, ctx) of every anchor of a table (doc, dig, text): strings start ``low`` to ``high`` bytes before ``at``."""
    reach = reach_of(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                for data, offs, row, place in _pieces(piece.column("text"), length):
                    at, first, last = anchors(data, offs, length)
                    if not len(at):
                        continue
                    hashes = Hashes(data)
                    low, high = at - last, at - first
                    core = hashes.of(at, at + length - reach + 1)
                    ctx = mix64(hashes.of(first, last + length) + (low * 65536 + high).astype(np.uint64))
                    part = np.searchsorted(offs, at, side="right") - 1
                    own = pa.array(row[part])
                    yield pa.RecordBatch.from_arrays(
                        [piece.column("doc").take(own), piece.column("dig").take(own), pa.array((at - offs[part] + place[part]).astype(np.int32)),
                         pa.array(low.astype(np.int16)), pa.array(high.astype(np.int16)), pa.array(core.view(np.int64)), pa.array(ctx.view(np.int64))],
                        names=["doc", "dig", "at", "low", "high", "core", "ctx"])

    return docs.mapInArrow(run, "doc long, dig long, at int, low short, high short, core long, ctx long")


def common(s: bytes, t: bytes) -> int:
    """Length of the common prefix."""
    high = min(len(s), len(t))
    if s[:high] == t[:high]:
        return high
    low = 0
    while high - low > 1:
        mid = (low + high) // 2
        if s[low:mid] == t[low:mid]:
            low = mid
        else:
            high = mid
    return low


def blind_order(strings: list[bytes]) -> list[int]:
    """The sorted order of strings by a blind trie: nodes hold a depth and the bytes that branch there (-1: the string ends)."""
    root: list | None = None  # a node is [depth, {byte: child}], a leaf is [-1, numbers of equal strings]
    for i, s in enumerate(strings):
        if root is None:
            root = [-1, [i]]
            continue
        path, node = [], root
        while node[0] >= 0:
            path.append(node)
            node = node[1].get(s[node[0]] if node[0] < len(s) else -1) or next(iter(node[1].values()))
        t = strings[node[1][0]]
        depth = common(s, t)
        if depth == len(s) == len(t):
            node[1].append(i)
            continue
        mine, other = (s[depth] if depth < len(s) else -1), (t[depth] if depth < len(t) else -1)
        above = [p for p in path if p[0] < depth]
        below = path[len(above)] if len(above) < len(path) else node
        if below[0] == depth:
            below[1][mine] = [-1, [i]]
            continue
        new = [depth, {other: below, mine: [-1, [i]]}]
        if above:
            above[-1][1][t[above[-1][0]] if above[-1][0] < len(t) else -1] = new
        else:
            root = new
    order, stack = [], [root] if root else []
    while stack:
        node = stack.pop()
        if node[0] < 0:
            order += node[1]
        else:
            stack += [node[1][b] for b in sorted(node[1], reverse=True)]
    return order


def deep_shallow(rows: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): strings sorted within groups, and the common prefix of each with the one before it (0 at a group's first).

    ``rows`` holds a string each, zeros behind its ``size`` bytes; ``group`` is ascending.
    """
    n = len(rows)
    width = min(SHALLOW, -(-rows.shape[1] // 8) * 8)
    head = np.zeros((n, width), dtype=np.uint8)
    head[:, :min(width, rows.shape[1])] = rows[:, :width]
    words = head.view(">u8").astype(np.uint64)
    order = np.arange(n)
    begin = np.flatnonzero(np.diff(group, prepend=-1))
    end = np.concatenate([begin[1:], [n]]) if n else begin
    depth = np.zeros(len(begin), dtype=np.int64)
    deep = []
    while True:
        many = end - begin > 1
        begin, end, depth = begin[many], end[many], depth[many]
        done = depth == words.shape[1]
        deep += zip(begin[done].tolist(), end[done].tolist(), strict=True)
        begin, end, depth = begin[~done], end[~done], depth[~done]
        if not len(begin):
            break
        # Multikey quicksort, all parts at once: each is dealt into less than, equal to and greater than its middle character.
        count = end - begin
        part = np.repeat(np.arange(len(begin)), count)
        spot = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + begin[part]
        char = words[order[spot], depth[part]]
        pivot = words[order[begin + count // 2], depth][part]
        side = part * 3 + (char >= pivot) + (char > pivot)
        order[spot] = order[spot][np.argsort(side, kind="stable")]
        sizes = np.bincount(side, minlength=3 * len(begin))
        ends = np.cumsum(sizes.reshape(-1, 3), axis=1) + begin[:, None]
        begin, end, depth = (ends - sizes.reshape(-1, 3)).ravel(), ends.ravel(), (depth[:, None] + np.array([0, 1, 0])).ravel()
    for a, b in deep:
        mine = order[a:b]
        order[a:b] = mine[blind_order([rows[i, :size[i]].tobytes() for i in mine.tolist()])]
    shared = np.zeros(n, dtype=np.int64)
    for a in range(1, n, 4096):
        x, y = order[a - 1:min(a + 4096, n) - 1], order[a:a + 4096]
        other = rows[x] != rows[y]
        first = np.where(other.any(1), other.argmax(1), rows.shape[1])
        shared[a:a + 4096] = np.where(group[x] == group[y], np.minimum(first, np.minimum(size[x], size[y])), 0)
    return order, shared


def _matrix(data: np.ndarray, start: np.ndarray, size: np.ndarray, width: int, step: int) -> np.ndarray:
    """Strings of ``size`` bytes from ``start``, read forwards (step 1) or backwards (-1), zeros behind them."""
    out = np.zeros((len(start), max(width, 1)), dtype=np.uint8)
    place = np.arange(max(width, 1))
    for a in range(0, len(start), 1024):
        inside = place[None, :] < size[a:a + 1024, None]
        out[a:a + 1024][inside] = data[(start[a:a + 1024, None] + step * place[None, :])[inside]]
    return out


def repeated_offsets(group: np.ndarray, low: np.ndarray, high: np.ndarray, data: np.ndarray, offs: np.ndarray, length: int) -> np.ndarray:
    """Which strings of which contexts another context of the group has too (rows x offsets left of the anchor)."""
    n, reach = len(group), int(high.max(initial=0)) + 1
    right = _matrix(data, offs[:-1] + high, length - low, length, 1)
    left = _matrix(data, offs[:-1] + high - 1, high, reach - 1, -1)
    orders = [deep_shallow(right, length - low, group), deep_shallow(left, high, group)]
    found = np.zeros((n, reach), dtype=bool)
    for d in range(int(low.min(initial=0)), reach):
        live = (low <= d) & (d <= high)
        runs = []
        for (order, shared), least in zip(orders, (length - d, d), strict=True):
            run = np.empty(n, dtype=np.int64)
            new = (shared < least) | (np.diff(group, prepend=-1) != 0)
            run[order] = np.cumsum(new)
            runs.append(run)
        key = (runs[0] * (n + 1) + runs[1])[live]
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        found[live, d] = count[back] > 1
    return found


def _solved(members: DataFrame, length: int) -> DataFrame:
    """(doc, dig, start, end): bytes of repeated strings of the contexts that occur once, from (doc, dig, at, low, high, n, core, bytes)."""
    def solve(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        at, low, high, times, core = (table.column(c).to_numpy().astype(np.int64) for c in ("at", "low", "high", "n", "core"))
        group = np.cumsum(np.diff(core, prepend=core[:1]) != 0)
        column = table.column("bytes").combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        offs = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
        data = np.frombuffer(column.buffers()[2], dtype=np.uint8)
        found = repeated_offsets(group, low, high, data, offs, length)
        found[times > 1] = False  # known to be repeated
        wide = np.zeros((len(found), found.shape[1] + 2), dtype=np.int8)
        wide[:, 1:-1] = found
        row, first = np.nonzero(np.diff(wide, axis=1) == 1)
        last = np.nonzero(np.diff(wide, axis=1) == -1)[1] - 1
        return pa.RecordBatch.from_arrays(
            [table.column(c).combine_chunks().take(pa.array(row)) for c in WHO] + [pa.array(at[row] - last), pa.array(at[row] - first + length)],
            names=[*WHO, "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, last = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            core, begin = batch.column("core").to_numpy(), 0
            for head in np.flatnonzero(np.diff(core, prepend=core[0] if last is None else last)).tolist():
                if count + head - begin >= BATCH:
                    if head > begin:
                        held.append(batch.slice(begin, head - begin))
                    yield solve(held)
                    held, count, begin = [], 0, head
            held.append(batch.slice(begin))
            count, last = count + batch.num_rows - begin, core[-1]
        if held:
            yield solve(held)

    ordered = members.select(*WHO, "at", "low", "high", "n", "core", "bytes").repartition("core").sortWithinPartitions("core", *WHO, "at")
    return ordered.mapInArrow(run, "doc long, dig long, start long, end long")


def _met(rows: DataFrame, keyed: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join rows with a table of one row per key; the rows of a key are dealt over ``SALTS`` parts."""
    dealt = keyed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
    return rows.withColumn("salt", F.pmod(F.hash("doc", "dig", "at"), F.lit(SALTS))).join(dealt, [*on, "salt"], how).drop("salt")


def _split(members: DataFrame, length: int) -> DataFrame:
    """The members of large groups, dealt by longer cores: each for a part of its offsets, with its bytes cut to them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, dig, at, low, high, n, core, lead, last, raw in zip(*(batch.column(c).to_pylist() for c in
                                                                         ("doc", "dig", "at", "low", "high", "n", "core", "lead", "last", "bytes")), strict=True):
                step = max(-(-(last - lead + 1) // SPLIT), 1)
                for a in range(lead, last + 1, step):
                    b = min(a + step - 1, last)
                    x, y = max(low, a), min(high, b)
                    if x <= y:
                        shared = raw[high - a:high + length - b]
                        name = hashlib.blake2b(shared, digest_size=8, salt=a.to_bytes(8, "little"), person=b.to_bytes(8, "little")).digest()
                        mine = raw[high - y:high + length - x]
                        what = hashlib.blake2b(mine, digest_size=8, salt=x.to_bytes(8, "little"), person=y.to_bytes(8, "little")).digest()
                        out.append((doc, dig, at, x, y, n, int.from_bytes(name, "little", signed=True), int.from_bytes(what, "little", signed=True), a, b, mine))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.int16(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            cols = list(zip(*out, strict=True)) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=["doc", "dig", "at", "low", "high", "n", "core", "ctx", "lead", "last", "bytes"])

    return members.mapInArrow(run, "doc long, dig long, at int, low short, high short, n long, core long, ctx long, lead int, last int, bytes binary")


def _ranges(rows: DataFrame, length: int) -> DataFrame:
    return rows.select(*WHO, (F.col("at") - F.col("high")).cast("long").alias("start"), (F.col("at") - F.col("low") + length).cast("long").alias("end"))


def _decided(members: DataFrame, length: int) -> tuple[DataFrame, list[DataFrame]]:
    """(doc, dig, start, end) of the members that occur once, and tables to release when it has been read.

    ``members`` (doc, dig, at, low, high, n, g, core, lead, last, bytes): one for each distinct context; ``g`` counts those of its core.
    """
    found, made = [_solved(members.where(F.col("g") <= LIMIT), length)], []
    large = members.where(F.col("g") > LIMIT)
    while not large.isEmpty():
        rows = staged(_split(large, length), "suffix-split")
        classes = rows.groupBy("core", "ctx").agg(F.sum("n").alias("n"), *[F.first(c).alias(c) for c in ("doc", "dig", "at", "low", "high", "lead", "last", "bytes")])
        classes = staged(classes, "suffix-classes")
        again = classes.where("n > 1").select("core", "ctx")
        found.append(_ranges(_met(rows.where("n = 1").drop("bytes"), again, ["core", "ctx"]), length))
        sizes = classes.groupBy("core").agg(F.count(F.lit(1)).alias("g")).where("g > 1")
        members = staged(_met(classes, sizes, ["core"]), "suffix-members")
        found.append(_solved(members.where(F.col("g") <= LIMIT), length))
        large = members.where((F.col("g") > LIMIT) & (F.col("lead") < F.col("last")))
        made += [rows, classes, members]
    out = found[0]
    for part in found[1:]:
        out = out.unionAll(part)
    return out, made


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs that ranges cover."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order]) if len(end) else end
    new = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]])) if len(start) else np.zeros(0, np.int64)
    return start[new], end[np.concatenate([new[1:] - 1, [len(start) - 1]])] if len(new) else end


DONE = "n_bytes long, spans array<struct<start:long,end:long>>, kept_sha256 string, kept binary"


def _finished(text: bytes, start: np.ndarray, end: np.ndarray, with_text: bool) -> tuple:
    a, b = merged(start, end)
    spans = [{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    edge = [0, *(x for s in spans for x in (s["start"], s["end"])), len(text)]
    kept = b"".join(text[x:y] for x, y in zip(edge[::2], edge[1::2], strict=True))
    return len(text), spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None


def _done_arrays(rows: list[tuple]) -> list[pa.Array]:
    kinds = [pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string(), pa.binary()]
    return [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]


def _work(joined: DataFrame, length: int, with_text: bool) -> DataFrame:
    """Per row of docs: its result where all is known, else its text, the known ranges and the contexts that are to be sorted."""
    spot = pa.struct([("at", pa.int32()), ("low", pa.int16()), ("high", pa.int16()), ("n", pa.int64()), ("g", pa.int64()), ("core", pa.int64()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            for piece in slices(batch, "text"):
                done, texts, known, spots = [], [], [], []
                who = list(zip(piece.column("doc").to_pylist(), piece.column("dig").to_pylist(), strict=True))
                about = piece.column("about")
                flat = [about.values.field(c).to_numpy(zero_copy_only=False) for c in ("at", "low", "high", "n", "g", "core")]
                offs = np.frombuffer(about.buffers()[1], dtype=np.int32)[about.offset:about.offset + len(about) + 1]
                for i, text in enumerate(pc.fill_null(piece.column("text").cast(pa.large_binary()), b"").to_pylist()):
                    at, low, high, n, g, core = (x[offs[i]:offs[i + 1]].astype(np.int64) for x in flat)
                    sure = n != 1  # n: 0 for known ranges, else the times a context occurs
                    start, end = (at - high)[n == 0], (at - low + length)[n == 0]
                    if sure.all():
                        done.append(_finished(text, start, end, with_text))
                        texts.append(None)
                        known.append(None)
                    else:
                        done.append((None,) * 4)
                        texts.append(text)
                        known.append([{"start": a, "end": b} for a, b in zip(*(x.tolist() for x in merged(start, end)), strict=True)])
                    asked = np.flatnonzero(n > 0) if who[i] != before else np.zeros(0, np.int64)  # once for rows that repeat each other
                    before = who[i]
                    spots.append([{"at": a, "low": x, "high": y, "n": t, "g": z, "core": c, "bytes": text[a - y:a - x + length]} for a, x, y, t, z, c in
                                  zip(*(v[asked].tolist() for v in (at, low, high, n, g, core)), strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), piece.column("doc"), piece.column("dig"), pa.array(texts, pa.binary()),
                     pa.array(known, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(spots, pa.list_(spot)), *_done_arrays(done)],
                    names=["id", "doc", "dig", "text", "known", "spots", "n_bytes", "spans", "kept_sha256", "kept"])

    return joined.mapInArrow(run, "id long, doc long, dig long, text binary, known array<struct<start:long,end:long>>, spots array<struct<at:int,low:short,high:short,"
                             f"n:long,g:long,core:long,bytes:binary>>, {DONE}")


def suffix_dedup(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """(doc_id, n_bytes, spans, kept_sha256, kept): for each row the maximal runs of removed bytes, and what is left (``kept``: null without ``with_text``).

    Texts are UTF-8 bytes, null is empty.  A byte goes when a string of ``length`` bytes covers it that starts anywhere else too: in another
    row, or elsewhere in its own, overlaps included; strings do not cross rows and are judged on the input.  Cuts may fall inside characters, so
    ``kept`` is binary.  Ids are integers; rows may repeat ids and texts (each row counts) and null ids are kept; an empty
    table gives an empty result; other columns are not read.
    """
    reach = reach_of(length)
    text = F.col(f"`{text_col}`")
    ident = F.col(f"`{id_col}`").cast("long")
    rows = docs.select(ident.alias("id"), F.coalesce(ident, F.lit(-1)).alias("doc"), F.xxhash64(text, ident.isNull()).alias("dig"), text.alias("text"))
    found = anchor_rows(rows.select(*WHO, "text"), length)
    cores = found.groupBy("core").agg(F.count(F.lit(1)).alias("n"), F.min("ctx").alias("a"), F.max("ctx").alias("b")).where("n > 1")
    cores = staged(cores.select("core", (F.col("a") == F.col("b")).alias("alike")), "suffix-cores")
    hits = staged(_met(found, cores, ["core"]), "suffix-hits")
    release(cores)
    mixed = hits.where(~F.col("alike")).drop("alike")
    classes = mixed.groupBy("core", "ctx").agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("doc", "dig", "at", "low", "high")])
    classes = staged(classes, "suffix-classes")
    again = _met(mixed, classes.where("n > 1").select("core", "ctx"), ["core", "ctx"])
    sizes = classes.groupBy("core").agg(F.count(F.lit(1)).alias("g"))
    nothing = [F.lit(0).cast("long").alias(c) for c in ("n", "g", "core")]
    about = hits.where("alike").select(*WHO, "at", "low", "high", *nothing).unionAll(again.select(*WHO, "at", "low", "high", *nothing)) \
        .unionAll(_met(classes, sizes, ["core"]).select(*WHO, "at", "low", "high", "n", "g", "core"))
    about = about.groupBy(*WHO).agg(F.collect_list(F.struct("at", "low", "high", "n", "g", "core")).alias("about"))  # bounded by the document's length
    work = staged(_work(rows.join(about.hint("merge"), WHO, "left"), length, with_text), "suffix-work")
    release(hits, classes)
    members = work.select(*WHO, F.explode("spots").alias("s")).select(*WHO, "s.*", F.lit(0).alias("lead"), F.lit(reach - 1).alias("last"))
    decided, made = _decided(members, length)
    decided = staged(decided, "suffix-ranges")
    release(*made)
    more = decided.groupBy(*WHO).agg(F.collect_list(F.struct("start", "end")).alias("more")).hint("merge")
    rest = work.where(F.col("n_bytes").isNull()).select("id", *WHO, "text", "known").join(more, WHO, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, known, extra in zip(*(batch.column(c).to_pylist() for c in ("text", "known", "more")), strict=True):
                both = [*known, *(extra or [])]
                out.append(_finished(raw, *(np.array([r[c] for r in both], dtype=np.int64) for c in ("start", "end")), with_text))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *_done_arrays(out)], names=["id", "n_bytes", "spans", "kept_sha256", "kept"])

    names = ["n_bytes", "spans", "kept_sha256", "kept"]
    last = rest.select("id", "text", "known", "more").mapInArrow(run, f"id long, {DONE}")
    return work.where(F.col("n_bytes").isNotNull()).select("id", *names).unionAll(last.select("id", *names)).withColumnRenamed("id", "doc_id")
