"""Line dedup by an exact set-similarity join.

A line is the set of its word shingles (its tokens; a line of fewer words is one
token).  Tokens are ordered rare first by a sketch counted over all lines.  Two
lines of Jaccard similarity t meet in a token of both prefixes (prefix filter);
lines that meet are bundled only over sizes that allow t (length filter); within
a bundle a pair is verified when the positions of its first common token leave
room for the overlap t needs (positional filter).  A line goes when an earlier
line (smaller document id, then line number) matches it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surge.llm import ngram_join as join
from surge.llm.batches import Texts, mix64, slices
from surge.llm.links import connected_components
from surge.llm.staging import staged


#: Tokens in a tile: some hundred lines, or one longer line.
TILE = 40_000
#: White space, of which a blank line has nothing else.
BLANK = " \t\n\x0b\f\r"
#: Lines of a class from which on they are dealt out by salt to be told their match.
MANY = 1024
#: Pairs of rows that are weighed at once.
PAIRS = 1 << 18
#: Bytes of text whose tokens are made at once.
BYTES = 1 << 19
#: Bits of a posting's key that hold the size of its line, and the largest size told from others.
SIZE_BITS = 16
WIDEST = (1 << SIZE_BITS) - 1
#: Least number of buckets of tokens (more with more shuffle partitions); postings (16 bytes each) a task holds before it sends or pairs them.
BUCKETS, HELD = 1024, 1 << 18


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, line_no, text) of the lines of all texts, blank lines left out."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.posexplode(F.split(F.col(f"`{text_col}`"), "\n")).alias("line_no", "text")) \
        .where(F.col("doc_id").isNotNull() & (F.ltrim("text", F.lit(BLANK)) != ""))


def split_lines(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(lines, row, line_no): the lines of all texts of a column, each with the line feed that ends it; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return column, np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    offs = offs - offs[0]
    feed = np.flatnonzero(data == 10)
    row = np.concatenate([np.arange(len(column)), np.searchsorted(offs, feed, side="right") - 1])
    order = np.argsort(row, kind="stable")
    start = np.concatenate([offs[:-1], feed + 1])[order]
    count = np.bincount(row, minlength=len(column))
    line_no = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    borders = np.concatenate([start, offs[-1:]])
    return pa.Array.from_buffers(pa.large_string(), len(row), [None, pa.py_buffer(borders), pa.py_buffer(data)]), row[order], line_no


def _packed(held: list[np.ndarray], buckets: int) -> tuple[pa.Array, pa.Array]:
    """(bucket, postings): rows (key, id) dealt by the hash of their token, all of a bucket end to end in one value."""
    rows = np.concatenate(held)
    bucket = (mix64((rows[:, 0] >> SIZE_BITS).astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    count = np.bincount(bucket, minlength=buckets)
    used = np.flatnonzero(count)
    borders = np.concatenate([[0], np.cumsum(count[used])]).astype(np.int32) * 16
    data = np.ascontiguousarray(rows[np.argsort(bucket, kind="stable")])
    return pa.array(used.astype(np.int32)), pa.Array.from_buffers(pa.binary(), len(used), [None, pa.py_buffer(borders), pa.py_buffer(data)])


def line_signatures(rows: DataFrame, sets: join.Sets, ranks: np.ndarray, num: int, den: int) -> DataFrame:
    """(id, doc_id, line_no, n, sig_a, sig_b, bucket, postings): ``ngram_join.signatures`` of the lines of texts (doc_id, text), cut in the task.

    Blank lines are left out; ``id`` numbers the lines.  A column ``hashes`` (one of each line) goes along as ``line_hash``.  The prefixes are
    in rows of their own, ``bucket`` not null: they are many and short, so they are stored and move as many in one value
    (``shared_tokens`` reads them).  A key is the upper bits of a token above the size of the set, from ``WIDEST`` on all one."""
    more = ["line_hash"] if "hashes" in rows.columns else []
    keys = ["id", "doc_id", "line_no", *more]
    buckets, most = max(BUCKETS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), HELD
    kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64() for _ in more], pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    names = [*keys, "n", "sig_a", "sig_b", "bucket", "postings"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        number = TaskContext.get().partitionId() << 33
        held: list[np.ndarray] = []
        waiting = 0

        def sent() -> pa.RecordBatch:
            bucket, postings = _packed(held, buckets)
            return pa.RecordBatch.from_arrays([*[pa.nulls(len(bucket), k) for k in kinds[:-2]], bucket, postings], names=names)

        for batch in batches:
            for piece in slices(batch, "text"):
                text, row, line_no = split_lines(piece.column("text"))
                columns = [pa.array(number + np.arange(len(row))), piece.column("doc_id").take(pa.array(row)), pa.array(line_no.astype(np.int32)),
                           *[piece.column("hashes").flatten() for _ in more], text]
                number += len(row)
                for part in slices(pa.RecordBatch.from_arrays(columns, names=[*keys, "text"]), "text", BYTES):
                    signed = join.signed_batch(part, sets, ranks, num, den, keys, seen)
                    n, sign, prefix = (signed.column(c) for c in ("n", "sig_a", "prefix"))
                    own = np.repeat(np.arange(len(n)), pc.list_value_length(prefix).to_numpy())
                    key = prefix.flatten().to_numpy() & ~WIDEST | np.minimum(n.to_numpy(), WIDEST)[own]
                    held.append(np.stack([key, sign.to_numpy()[own]], axis=1))
                    waiting += len(own)
                    yield pa.RecordBatch.from_arrays([*signed.columns[:-1], *[pa.nulls(len(n), k) for k in kinds[-2:]]], names=names)
                    if waiting >= most:
                        yield sent()
                        held, waiting = [], 0
        if waiting:
            yield sent()

    hashes = "".join(f", {c} long" for c in more)
    return rows.mapInArrow(run, f"id long, doc_id long, line_no int{hashes}, n long, sig_a long, sig_b long, bucket int, postings binary") \
        .where("n > 0 OR bucket IS NOT NULL")


def _heads(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, pairs): the first id of every key, and pairs that hang the key's other ids under it."""
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    new = np.diff(rows[:, 0], prepend=~rows[:1, 0]) != 0
    head = rows[new, 1][np.cumsum(new) - 1]
    return rows[new], np.unique(np.stack([head, rows[:, 1]])[:, head != rows[:, 1]], axis=1)


def _runs(rows: np.ndarray, num: int, den: int) -> np.ndarray:
    """Pairs that hold together the ids of every token, each run of sizes without a gap under its first id."""
    rows = rows[np.argsort(rows[:, 0], kind="stable")]
    tok = rows[:, 0] >> SIZE_BITS
    same = tok[1:] == tok[:-1]
    rows = rows[np.append(same, False) | np.insert(same, 0, False)]  # most tokens are one line's alone
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    tok, n = rows[:, 0] >> SIZE_BITS, rows[:, 0] & WIDEST
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (tok[1:] != tok[:-1]) | ((den * n[:-1] < num * n[1:]) & (n[1:] < WIDEST))
    head = rows[new, 1][np.cumsum(new) - 1]
    return np.unique(np.stack([head, rows[:, 1]])[:, head != rows[:, 1]], axis=1)


def shared_tokens(packed: DataFrame, num: int, den: int) -> DataFrame:
    """Edges (a, b) as ``ngram_join.bundle_edges`` gives them, from (bucket, postings) of ``line_signatures``.

    Buckets are read some ``HELD`` postings at a time; of a larger one the ids that share a key are paired as they come, and one is kept.
    Tokens that agree in their upper bits, and lines of ``WIDEST`` tokens or more, are only held together more often."""
    ordered = packed.repartition("bucket").sortWithinPartitions("bucket")
    most = HELD

    def batch_of(pairs: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        waiting, last = 0, None
        for batch in batches:
            for bucket, raw in zip(batch.column("bucket").to_pylist(), batch.column("postings").to_pylist(), strict=True):
                if waiting >= most:
                    rows, held, waiting = np.concatenate(held), [], 0
                    if bucket != last:
                        yield batch_of(_runs(rows, num, den))
                    else:
                        kept, pairs = _heads(rows)
                        held.append(kept)
                        yield batch_of(pairs)
                held.append(np.frombuffer(raw, dtype=np.int64).reshape(-1, 2))
                waiting, last = waiting + len(held[-1]), bucket
        if held:
            yield batch_of(_runs(np.concatenate(held), num, den))

    return ordered.mapInArrow(run, "a long, b long").distinct()


def needed_overlap(a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Least overlap of sets of sizes a and b at similarity num / den."""
    return -(-(a + b) * num // (num + den))


def matches(tokens: np.ndarray, size: np.ndarray, tile: np.ndarray, side: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows at least num / den similar, of a left and a right row of one tile; row i before row j where rows are both.

    ``tokens`` holds the sets end to end, each in the common order (rare first), ``size`` their sizes, ``tile`` ascending tile numbers,
    ``side`` 0 (left), 1 (right) or 2 (both).  Pairs come from the tokens of both prefixes, for some left rows at a time; the sizes and
    the positions of the first common token must leave room for the needed overlap; the rest is verified by merging."""
    count = len(size)
    upto = np.concatenate([[0], np.cumsum(size)])
    owner = np.repeat(np.arange(count), size)
    place = np.arange(len(tokens)) - upto[owner]
    column = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    head = np.flatnonzero(place < (size - join.least_overlap(size, num, den) + 1)[owner])
    # A token of one tile is not that of another: the prefixes' postings are by (tile, token), within one by row.
    own, at = owner[head], place[head]
    named = np.unique(tile[own] * np.int64(len(tokens) + 1) + column[head], return_inverse=True)[1]
    is_right = side[own] != 0
    order = np.argsort(named[is_right], kind="stable")
    posting, posted = own[is_right][order], at[is_right][order]
    begin = np.concatenate([[0], np.cumsum(np.bincount(named[is_right], minlength=int(named.max(initial=-1)) + 1))])
    start = begin[named]
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    both = side[own] == 2
    start[both] = rank[both[is_right]] + 1  # only the rows behind it
    reach = np.where(side[own] != 1, begin[named + 1] - start, 0)
    used = np.flatnonzero(reach)
    start, reach, own, at = start[used], reach[used], own[used], at[used]
    # Left rows in runs of some ``PAIRS`` pairs, or one row.
    pairs = np.cumsum(np.bincount(own, minlength=count))
    weight = np.cumsum(np.bincount(own, weights=reach, minlength=count))
    out, row = [], 0
    while row < count:
        done = weight[row - 1] if row else 0
        upto_row = max(row + 1, int(np.searchsorted(weight, done + PAIRS, side="right")))
        some = slice(int(pairs[row - 1]) if row else 0, int(pairs[upto_row - 1]))
        row = upto_row
        times = reach[some]
        if not len(times):
            continue
        hit = np.repeat(start[some] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        u, r, v, s = np.repeat(own[some], times), np.repeat(at[some], times), posting[hit], posted[hit]
        fits = (den * size[u] >= num * size[v]) & (den * size[v] >= num * size[u])
        u, r, v, s = u[fits], r[fits], v[fits], s[fits]
        lead = np.unique(u * np.int64(count) + v, return_index=True)[1]  # the first common token of a pair
        u, r, v, s = u[lead], r[lead], v[lead], s[lead]
        room = 1 + np.minimum(size[u] - r - 1, size[v] - s - 1) >= needed_overlap(size[u], size[v], num, den)
        out.append((u[room], v[room]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    u, v = (np.concatenate(x) for x in zip(*out, strict=True))
    if not len(u):
        return u, v
    # Verify, row by row of the left side: flag its tokens and count the flags that each partner hits.
    flag = np.zeros(int(column.max(initial=-1)) + 1, dtype=np.int64)
    overlap = np.zeros(len(u), dtype=np.int64)
    first = np.flatnonzero(np.diff(u, prepend=-1))
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(u)], strict=True):
        mine = column[upto[u[a]]:upto[u[a] + 1]]
        flag[mine] = 1
        n = size[v[a:b]]
        begins = np.cumsum(n) - n
        hit = np.repeat(upto[v[a:b]] - begins, n) + np.arange(n.sum())
        overlap[a:b] = np.add.reduceat(flag[column[hit]], begins)
        flag[mine] = 0
    enough = den * overlap >= num * (size[u] + size[v] - overlap)
    return u[enough], v[enough]


def earlier_matches(tiles: DataFrame, sets_of: join.Sets, ranks: np.ndarray, num: int, den: int) -> DataFrame:
    """(id, match_doc, match_line): for each line that has one in its tile pair, the earliest earlier match."""
    ordered = tiles.repartition("key").sortWithinPartitions("key", "doc_id", "line_no")
    names = ["tile", "id", "side", "doc_id", "line_no", "size"]

    def solve(rows: dict[str, np.ndarray], tokens: np.ndarray) -> pa.RecordBatch | None:
        """Rows are in the order of their lines within a tile, so the earliest match is the least row."""
        u, v = matches(tokens, rows["size"], rows["tile"], rows["side"], num, den)
        spot = np.cumsum(np.any([np.diff(rows[c], prepend=-1) != 0 for c in ("tile", "doc_id", "line_no")], axis=0))
        early, late = np.minimum(u, v), np.maximum(u, v)
        apart = spot[early] != spot[late]  # not rows that share id and text
        count = len(spot)
        best = np.full(count, count)
        np.minimum.at(best, late[apart], early[apart])
        got = np.flatnonzero(best < count)
        if not len(got):
            return None
        return pa.RecordBatch.from_arrays([pa.array(rows["id"][got]), pa.array(rows["doc_id"][best[got]]), pa.array(rows["line_no"][best[got]])],
                                          names=["id", "match_doc", "match_line"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[dict[str, np.ndarray], np.ndarray]] = []
        key, tile, waiting = None, 0, 0

        def joined() -> tuple[dict[str, np.ndarray], np.ndarray]:
            return {c: np.concatenate([x[c] for x, _ in held]) for c in names}, np.concatenate([t for _, t in held])

        for batch in batches:
            for piece in slices(batch, "text", BYTES):
                doc, code, count = sets_of(piece.column("text"))
                tokens = code[join.rare_first(doc, code, ranks)]
                own = [key, *piece.column("key").to_pylist()]
                number = tile + np.cumsum([a != b for a, b in zip(own[:-1], own[1:], strict=True)])
                key, tile = own[-1], int(number[-1])
                rows = {c: piece.column(c).to_numpy().astype(np.int64) for c in names[1:-1]}
                held.append((rows | {"tile": number, "size": np.bincount(doc, minlength=count).astype(np.int64)}, tokens))
                waiting += len(tokens)
                if waiting < TILE or int(held[0][0]["tile"][0]) == tile:
                    continue
                rows, tokens = joined()  # the last tile may go on
                cut = int(np.searchsorted(rows["tile"], tile))
                edge = int(rows["size"][:cut].sum())
                if (got := solve({c: x[:cut] for c, x in rows.items()}, tokens[:edge])) is not None:
                    yield got
                held, waiting = [({c: x[cut:] for c, x in rows.items()}, tokens[edge:])], len(tokens) - edge
        if held and (got := solve(*joined())) is not None:
            yield got

    return ordered.select("key", "id", "side", "doc_id", F.col("line_no").cast("long").alias("line_no"), "text") \
        .mapInArrow(run, "id long, match_doc long, match_line long")


def repeated_lines(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text",
                   with_hash: bool = False) -> DataFrame:
    """(doc_id, line_no, match_doc, match_line): every line that an earlier line matches, with its earliest match.

    Lines end at a line feed and count from 0.  Words are runs between ASCII white space, lower-cased A-Z; blank lines, null
    and empty texts have no tokens and match nothing.  Rows with a null id are left out; a line that rows of one id share at
    one place is its own match, and stays once.  An empty table gives an empty result; other columns are not read.
    ``with_hash`` adds ``line_hash`` (xxhash64 of the line), which tells apart the lines of different texts under one id.
    """
    def sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
        return join.shingle_sets(column, k)

    def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
        """The tokens of all lines of whole texts, for ``rarity``, which counts the codes alone; a line's repeats count."""
        cut = pa.RecordBatch.from_arrays([split_lines(column)[0]], names=["text"])
        made = [Texts(part.column("text")).words().shingles(k) for part in slices(cut, "text", BYTES)]
        doc, code = (np.concatenate([x[i] for x in made]) if made else np.zeros(0, t) for i, t in enumerate((np.int64, np.uint64)))
        return doc, code, len(column)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")) \
        .where("doc_id IS NOT NULL AND text IS NOT NULL")
    ranks = join.rarity(rows, tokens)
    hashes = F.transform(F.split("text", "\n"), lambda x: F.xxhash64(x))
    both = staged(line_signatures(rows.withColumn("hashes", hashes) if with_hash else rows, sets, ranks, num, den), "line-signatures")
    signed = both.where("bucket IS NULL").drop("bucket", "postings")
    sig = ["sig_a", "sig_b", "n"]  # what tells most rows apart comes first in a sort
    classes = signed.groupBy(*sig).agg(F.min(F.struct("doc_id", "line_no", "id")).alias("rep"), F.count(F.lit(1)).alias("size"))
    classes = staged(classes.select(*sig, "size", F.col("rep.id").alias("id"), F.col("rep.doc_id").alias("rep_doc"), F.col("rep.line_no").alias("rep_line")), "line-classes")
    bundles = connected_components(shared_tokens(both.where("bucket IS NOT NULL").select("bucket", "postings"), num, den)) \
        .select(F.col("node").alias("sig_a"), F.col("component").alias("bundle"))
    leads = classes.select("id", F.col("rep_doc").alias("doc_id"), F.col("rep_line").alias("line_no"), "n", "sig_a")
    members = staged(leads.join(bundles, "sig_a"), "line-members")
    spot = ["doc_id", "line_no", "sig_a"]
    few = join.sketched(line_table(docs, id_col, text_col), members, spot[:2])  # the other lines' texts stay where they are
    few = staged(join.signatures(few, sets, None, num, den, [*spot[:2], "text"]).select(*spot, "text"), "line-texts")
    members = join.sharper(members, few, spot, sets, num, den, TILE)
    dealt = join.tile_keys(members, num, den, tuple(spot), TILE)
    tiles = few.join(dealt, spot)
    early = earlier_matches(tiles, sets, ranks, num, den) \
        .groupBy("id").agg(F.min(F.struct("match_doc", "match_line")).alias("early"))
    early = staged(early, "line-matches")  # the texts' shuffle ends here
    told = classes.join(early, "id", "left").where("size > 1 OR early IS NOT NULL").select(
        *sig, F.coalesce("early", F.struct(F.col("rep_doc").alias("match_doc"), F.col("rep_line").cast("long").alias("match_line"))).alias("match"),
        F.col("id").alias("rep"), "early", "size")
    told = staged(told, "line-told")
    small, large = told.where(F.col("size") <= MANY), told.where(F.col("size") > MANY)
    salted = join.sketched(signed, large, sig).withColumn("salt", F.pmod(F.hash("doc_id", "line_no"), F.lit(join.SALTS))) \
        .join(large.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(join.SALTS - 1)))), [*sig, "salt"]).drop("salt")
    found = join.sketched(signed, small, sig).join(small, sig).unionByName(salted)
    return found.where("id <> rep OR early IS NOT NULL") \
        .select("doc_id", F.col("line_no").cast("long").alias("line_no"), "match.match_doc", "match.match_line",
                *(["line_hash"] if with_hash else []))


def drop_lines(docs: DataFrame, repeated: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the repeated lines; other columns, and documents without such lines, unchanged.

    A line goes by id, place and hash, so different texts under one id keep their own lines; without ``line_hash`` it goes
    only where all rows of its id have the same line at that place.  Of a line that is its own
    match (rows that share id, place and line) the row with the least text keeps it; equal rows are told apart, one keeps it.
    """
    if "line_hash" not in repeated.columns:
        held = line_table(docs.join(repeated.select(F.col("doc_id").alias("_line_doc")).distinct(), F.col(f"`{id_col}`").cast("long") == F.col("_line_doc"), "left_semi"),
                          id_col, text_col).groupBy("doc_id", "line_no").agg(F.min(F.xxhash64("text")).alias("line_hash"), F.max(F.xxhash64("text")).alias("_most"))
        repeated = repeated.join(held.where(F.col("line_hash") == F.col("_most")).drop("_most"), ["doc_id", "line_no"])
    own = F.col("match_doc").eqNullSafe(F.col("doc_id")) & (F.col("match_line") == F.col("line_no"))
    spot = F.struct(F.col("line_no").alias("line_no"), F.col("line_hash").alias("line_hash"))
    gone = repeated.groupBy("doc_id").agg(F.collect_set(F.when(~own, spot)).alias("_line_gone"), F.collect_set(F.when(own, spot)).alias("_line_own")) \
        .withColumnRenamed("doc_id", "_line_doc")  # a document's own lines
    joined = docs.withColumn("_line_key", F.col(f"`{id_col}`").cast("long")).join(gone, F.col("_line_key") == F.col("_line_doc"), "left")
    parts = F.transform(F.split(F.col(f"`{text_col}`"), "\n"), lambda x, i: F.struct(i.cast("long").alias("line_no"), F.xxhash64(x).alias("line_hash"), x.alias("line")))
    rows = joined.withColumn("_line_parts", parts)
    # Rows with lines of their own: each such line stays in the first row of the id that has it.  Such rows repeat an id.
    shared = F.size(F.coalesce("_line_own", F.array())) > 0
    order = Window.partitionBy("_line_key").orderBy(F.col(f"`{text_col}`"))
    several = rows.where(shared).withColumn("_line_row", F.row_number().over(order))
    has = F.filter("_line_own", lambda s: F.exists("_line_parts", lambda p: (p["line_no"] == s["line_no"]) & (p["line_hash"] == s["line_hash"])))
    before = F.flatten(F.collect_list(has).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    several = several.withColumn("_line_before", F.array_intersect(has, before)) \
        .withColumn("_line_gone", F.array_union("_line_gone", "_line_before")).drop("_line_row", "_line_before")
    rows = rows.where(~shared).unionAll(several)
    left = F.filter("_line_parts", lambda p: ~F.exists("_line_gone", lambda s: (s["line_no"] == p["line_no"]) & (s["line_hash"] == p["line_hash"])))
    new = F.when(F.col("_line_gone").isNull() | F.col(f"`{text_col}`").isNull(), F.col(f"`{text_col}`")).otherwise(F.array_join(F.transform(left, lambda p: p["line"]), "\n"))
    return rows.withColumn("_line_text", new).select(*[F.col("_line_text").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def dedup_lines(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the lines that an earlier line matches; rules as in ``repeated_lines`` and ``drop_lines``."""
    found = staged(repeated_lines(docs, k, num, den, id_col, text_col, with_hash=True), "line-repeats")
    return drop_lines(docs, found, id_col, text_col)
