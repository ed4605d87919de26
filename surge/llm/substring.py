"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes of a text; a position whose hash is the least of
some ``REACH`` positions in a row ends a chunk, so borders depend on nearby bytes
only and move with the text when something is inserted.  Chunks are grouped by
digest; every chunk but the first of its group (smallest document, then position)
is a repeat, and neighbouring repeats with neighbouring first occurrences form a run.

A repeated passage of WINDOW + 2 * REACH = 140 bytes holds at least one whole chunk,
whatever stands around it.  Its outer, partial chunks are found by comparing the
texts: each run is extended to both sides, by whole words, as far as its first
occurrence goes on alike.  The length rule applies to the extended span.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surge.llm.batches import SPACE, Texts, mix64, slices
from surge.llm.staging import staged

WINDOW = 16
#: A chunk ends where the hash is the least of so many positions in a row: every 32 bytes on average.
REACH = 62
#: Equal hashes nearer than this (one byte or syllable over and over) end a chunk only every half REACH.
NEAREST = 8
#: Bytes compared on each side of a run; a longer common stretch holds another run.
CONTEXT = WINDOW + 2 * REACH
#: A common stretch begins at most so far before its first whole chunk, and ends at most so far behind its last.
BEFORE, AFTER = WINDOW - 1 + REACH, REACH - 1
#: Bits of a position within a slice.
PLACE = np.uint64(30)
SALTS = 4
_GEAR = (mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)))


def borders(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Ends of chunks (byte positions, each the first byte of the next chunk), document ends included."""
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    ends = offs[1:][np.diff(offs) > 0]
    n = len(data)
    if n <= WINDOW + REACH:
        return ends
    h = _GEAR[data]
    for step in (1, 2, 4, 8):
        h[step:] = h[step:] + (h[:-step] << np.uint64(step))
    # Key of position p (the hash of the 16 bytes before it): the hash, then the later position first.
    place = np.arange(1, n, dtype=np.uint64)
    last = np.uint64((1 << int(PLACE)) - 1)
    key = (mix64(h[:-1]) & ~last) | (last - place)
    closed = (data[1:] & 0xC0) == 0x80  # inside a character
    key[closed] = ~np.uint64(0)
    low, width = key, 1
    while 2 * width <= REACH:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:len(key) - REACH + 1], low[REACH - width:])
    # A window of positions p .. p + REACH - 1 counts if its bytes, WINDOW before p included, are one document's.
    begin = np.arange(1, len(low) + 1)
    doc = np.searchsorted(offs, begin, side="right") - 1
    whole = (begin - offs[doc] >= WINDOW) & (begin + REACH - 1 < offs[doc + 1])
    low = low[whole]
    low = low[np.concatenate([[True], low[1:] != low[:-1]])] if len(low) else low
    at = (last - (low & last)).astype(np.int64)
    if len(at):
        near = np.zeros(len(at), dtype=bool)
        near[1:] = (np.diff(at) < NEAREST) & ((low[1:] | last) == (low[:-1] | last))
        head = np.maximum.accumulate(np.where(near, 0, np.arange(len(at))))
        turn = (at - at[head]) // (REACH // 2)
        at = at[~near | (turn != np.concatenate([[0], turn[:-1]]))]
    return np.unique(np.concatenate([at, ends]))


def chunk_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, start, size, digest of the chunk and the ``WINDOW`` bytes before it, words) of every chunk, from a table (doc_id, text).

    ``words`` packs four counts: w0, words of the document that end before the chunk; w1 - w0, with w1 the words that
    begin before its end; words that ``BEFORE`` bytes more to the left add, and ``AFTER`` bytes to the right (a byte each).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                texts = Texts(piece.column("text"), lower=False)
                ends = borders(texts.data, texts.offs)
                if not len(ends):
                    continue
                doc = np.searchsorted(texts.offs, ends, side="left") - 1
                starts = np.maximum(np.concatenate([[0], ends[:-1]]), texts.offs[doc])
                words = texts.words(SPACE)
                w0 = np.searchsorted(words.ends, starts, side="right") - words.first[doc]
                w1 = np.searchsorted(words.starts, ends, side="left") - words.first[doc]
                before = w0 - np.maximum(np.searchsorted(words.ends, starts - BEFORE, side="right") - words.first[doc], 0)
                after = np.minimum(np.searchsorted(words.starts, ends + AFTER, side="left"), words.first[doc + 1]) - words.first[doc] - w1
                # With the bytes that made its border: a chunk of few bytes does not match by chance.
                words.starts, words.ends = np.maximum(starts - WINDOW, texts.offs[doc]), ends
                digest = words.hashes()
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").take(pa.array(doc)), pa.array((starts - texts.offs[doc]).astype(np.int32)),
                     pa.array((ends - starts).astype(np.int32)), pa.array(digest.view(np.int64)),
                     pa.array(w0 << 24 | (w1 - w0) << 16 | before << 8 | after)],
                    names=["doc_id", "start", "size", "digest", "words"])

    return docs.mapInArrow(run, "doc_id long, start int, size int, digest long, words long")


def _edges(again: DataFrame, least_bytes: int, least_words: int) -> DataFrame:
    """The ends of runs of repeated chunks, from which a cluster (runs that touch) may be extended.

    (doc_id, start, end, w0, w1, lead): bytes and words of the cluster, first occurrence of its first chunk;
    (at, left, rank): the run's end, and w0 or w1 there; (first_doc, first_at): that place in its first occurrence.
    Ends too far inside to reach out of the cluster are left out, and clusters that could not count
    with the longest common stretch around them.
    """
    names = ["doc_id", "start", "end", "w0", "w1", "lead", "at", "rank", "first_doc", "first_at", "left"]

    def rows(doc, start, size, words, first, first_start) -> pa.RecordBatch:
        """Rows of chunks of whole clusters (chunks that touch)."""
        w0, before, after = words >> 24, words >> 8 & 255, words & 255
        w1 = w0 + (words >> 16 & 255)
        end, shift = start + size, first_start - start
        cluster = np.ones(len(doc), dtype=bool)
        cluster[1:] = (doc[1:] != doc[:-1]) | (start[1:] > end[:-1])
        new = cluster.copy()
        new[1:] |= (start[1:] != end[:-1]) | (first[1:] != first[:-1]) | (shift[1:] != shift[:-1])
        at = np.flatnonzero(cluster)
        most = np.maximum.reduceat(w1 + after, at) - np.minimum.reduceat(w0 - before, at)
        may = (most >= least_words) | (np.maximum.reduceat(end, at) - start[at] >= least_bytes)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(doc)) - 1
        of = np.cumsum(cluster)[head] - 1
        first_byte, last_byte = start[at], np.maximum.reduceat(end, at)
        w_first, w_last = np.minimum.reduceat(w0, at), np.maximum.reduceat(w1, at)
        parts = []
        for left in (True, False):
            place, rank = (start[head], w0[head]) if left else (end[tail], w1[tail])
            near = place - first_byte[of] < CONTEXT if left else last_byte[of] - place < CONTEXT
            k = np.flatnonzero(may[of] & near)
            c = of[k]
            parts.append([doc[head[k]], first_byte[c], last_byte[c], w_first[c], w_last[c], first[at][c], place[k], rank[k],
                          first[head[k]], place[k] + shift[head[k]], np.full(len(k), left)])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the chunks of the cluster that may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(i).to_numpy().astype(np.int64) for i in range(batch.num_columns)]
            if held is not None:
                now = [np.concatenate([h, x]) for h, x in zip(held, now, strict=True)]
            doc, start, end = now[0], now[1], now[1] + now[2]
            head = np.flatnonzero((doc[1:] != doc[:-1]) | (start[1:] > end[:-1]))
            cut = int(head[-1]) + 1 if len(head) else 0
            held = [x[cut:] for x in now]
            if cut:
                yield rows(*[x[:cut] for x in now])
        if held is not None:
            yield rows(*held)

    ordered = again.repartition("doc_id").sortWithinPartitions("doc_id", "start") \
        .select("doc_id", "start", "size", "words", "first_doc", "first_start")
    return ordered.mapInArrow(run, ", ".join(f"{x} long" for x in names[:-1]) + ", left boolean")


def _contexts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, at, left, bytes) for each wanted (doc_id, at, left): ``CONTEXT`` bytes on that side and one on the other;
    one row each, also if documents share an id."""
    asked = wanted.distinct().groupBy("doc_id").agg(F.collect_list(F.struct("at", "left")).alias("asked"))  # at most two a chunk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                out: list[tuple] = []
                for doc, text, ask in zip(*(piece.column(c).to_pylist() for c in ("doc_id", "text", "asked")), strict=True):
                    raw = (text or "").encode()
                    for a in ask:
                        at, left = a["at"], a["left"]
                        out.append((doc, at, left, raw[max(0, at - CONTEXT):at + 1] if left else raw[at - 1:at + CONTEXT]))
                if out:
                    doc, at, left, data = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(at, pa.int64()), pa.array(left, pa.bool_()),
                                                      pa.array(data, pa.binary())], names=["doc_id", "at", "left", "bytes"])

    return rows.join(asked, "doc_id").mapInArrow(run, "doc_id long, at long, left boolean, bytes binary") \
        .groupBy("doc_id", "at", "left").agg(F.min("bytes").alias("bytes"))


_BLANK = frozenset(b"\t\n\x0b\x0c\r ")


def extension(own: bytes, first: bytes, left: bool, own_open: bool, first_open: bool) -> tuple[int, int]:
    """(bytes, words) by which a run goes on over whole words, from the contexts of one of its ends.

    ``own_open``, ``first_open``: the text may go on beyond the context; else it ends there, which ends a word.
    """
    if left:
        # To the left the bytes are read backwards; the last one lies within the run.
        own, first = own[::-1], first[::-1]
    limit = min(len(own), len(first))
    m = 1
    while m < limit and own[m] == first[m]:
        m += 1

    def blank(data: bytes, i: int, open_: bool) -> bool:
        return data[i] in _BLANK if i < len(data) else not open_

    best = words = count = 0
    for i in range(1, m):
        if own[i] in _BLANK:
            continue
        count += own[i - 1] in _BLANK  # to the left a word ends here, to the right one begins
        if blank(own, i + 1, own_open) and blank(first, i + 1, first_open):
            best, words = i, count
    return best, words


def _extended(edges: DataFrame, contexts: DataFrame) -> DataFrame:
    """(doc_id, s, e, u0, u1, start, end, lead): clusters extended from one end; s to e are their bytes, u0 and u1 as w0 and w1."""
    own = contexts.withColumnRenamed("bytes", "own")
    first = contexts.select(F.col("doc_id").alias("first_doc"), F.col("at").alias("first_at"), "left", F.col("bytes").alias("first"))
    # A passage that many documents share asks for one place: the session's skew join splits it.
    both = edges.join(own, ["doc_id", "at", "left"]).join(first, ["first_doc", "first_at", "left"])
    names = ["doc_id", "s", "e", "u0", "u1", "start", "end", "lead"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, start, end, w0, w1, lead, at, rank = (batch.column(c).to_numpy().astype(np.int64) for c in (
                "doc_id", "start", "end", "w0", "w1", "lead", "at", "rank"))
            left = batch.column("left").to_numpy(zero_copy_only=False).astype(bool)
            got = [extension(a, b, side, len(a) > CONTEXT, len(b) > CONTEXT) for a, b, side in zip(
                batch.column("own").to_pylist(), batch.column("first").to_pylist(), left.tolist(), strict=True)]
            size, words = np.array(got, dtype=np.int64).reshape(-1, 2).T
            out = (doc, np.where(left, np.minimum(start, at - size), start), np.where(left, end, np.maximum(end, at + size)),
                   np.where(left, np.minimum(w0, rank - words), w0), np.where(left, w1, np.maximum(w1, rank + words)), start, end, lead)
            yield pa.RecordBatch.from_arrays([*map(pa.array, out)], names=names)

    return both.select("doc_id", "start", "end", "w0", "w1", "lead", "at", "rank", "left", "own", "first") \
        .mapInArrow(run, ", ".join(f"{x} long" for x in names))


def repeated_spans(docs: DataFrame, least_bytes: int = 140, within_document: bool = False, id_col: str = "doc_id",
                   text_col: str = "text", least_words: int = 50) -> DataFrame:
    """(doc_id, start, end, first_doc_id): spans of UTF-8 bytes that repeat text of an earlier document.

    A span is a run of repeated chunks, extended by the words next to it that the
    first occurrence has too, and joined with the runs it meets.  It counts if it
    has at least ``least_words`` words (as far as they lie in it), or ``least_bytes``
    bytes from its first whole chunk to its last.  Every passage of ``least_words`` words and 140 bytes that stands in
    an earlier document is found, shorter ones as their chunks fall.
    ``first_doc_id`` holds the first occurrence of the span's first chunk.
    ``within_document``: repeats of a document's own text count too.  Null and empty texts have no
    chunks; rows that share an id count as one occurrence; rows with a null id are left out; an empty table gives an empty
    result; other columns are not read.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).where("doc_id IS NOT NULL")
    chunks = chunk_rows(rows)
    firsts = chunks.groupBy("digest", "size").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count(F.lit(1)).alias("n")) \
        .where("n > 1").select("digest", "size", F.col("first.doc_id").alias("first_doc"), F.col("first.start").alias("first_start"),
                               F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = chunks.withColumn("salt", F.pmod(F.hash("doc_id"), F.lit(SALTS)))
    again = dealt.join(firsts, ["digest", "size", "salt"])
    again = again.where((F.col("first_doc") != F.col("doc_id")) if not within_document
                        else (F.col("first_doc") != F.col("doc_id")) | (F.col("first_start") != F.col("start")))
    again = again.select("doc_id", "start", "size", "words", "first_doc", "first_start")
    edges = staged(_edges(again, least_bytes, least_words), "substring-edges")
    wanted = edges.select("doc_id", "at", "left").unionAll(edges.select("first_doc", "first_at", "left"))
    contexts = staged(_contexts(rows, wanted), "substring-contexts")
    ordered = _extended(edges, contexts).repartition("doc_id").sortWithinPartitions("doc_id", "s", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the span that may go on: doc, s, e, u0, u1, start, end, first

        def counts(x: list) -> bool:
            return x[4] - x[3] >= least_words or x[6] - x[5] >= least_bytes

        for batch in batches:
            done = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
                if held is not None and held[0] == row[0] and row[1] <= held[2]:
                    held[2], held[3], held[4] = max(held[2], row[2]), min(held[3], row[3]), max(held[4], row[4])
                    held[5], held[6] = min(held[5], row[5]), max(held[6], row[6])
                else:
                    if held is not None and counts(held):
                        done.append(held)
                    held = list(row)
            yield _spans(done)
        if held is not None and counts(held):
            yield _spans([held])

    return ordered.mapInArrow(run, "doc_id long, start long, end long, first_doc_id long")


def _spans(held: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in held], pa.int64()) for i in (0, 1, 2, 7)],
                                      names=["doc_id", "start", "end", "first_doc_id"])


def remove_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the spans cut out of their texts; other columns, and documents without spans, unchanged."""
    cuts = spans.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_cuts")) \
        .select(F.col("doc_id").alias("_cut_id"), "_cuts")  # bounded by the document's own length
    joined = docs.withColumn("_cut_key", F.col(f"`{id_col}`").cast("long")).join(cuts, F.col("_cut_key") == F.col("_cut_id"), "left")
    rows = joined.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"), "_cuts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, cut in zip(batch.column("text").to_pylist(), batch.column("_cuts").to_pylist(), strict=True):
                if text is not None and cut:
                    raw, at, parts = text.encode(), 0, []
                    for c in cut:
                        parts.append(raw[at:c["start"]])
                        at = max(at, c["end"])
                    text = b"".join([*parts, raw[at:]]).decode("utf-8", "replace")
                out.append(text)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], names=["row", "new"])

    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("new", T.StringType())])
    done = rows.mapInArrow(run, schema)
    return done.select(*[F.col("new").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
