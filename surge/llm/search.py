"""Ranked lexical search by presence masks.

Documents are dealt into segments of an inverted index: a segment holds its documents'
ids and lengths and, for each of its terms, the documents that hold it with their counts.
A search reads the index once for the statistics of the asked terms and once to rank.

Within a segment an item's terms are bits: bitmaps of the terms are combined into one
presence mask per document, and documents with equal masks form a group.  A group's
score is at most the sum of its terms' best contributions in the segment.  Groups are
scored in descending order of that bound, until the next bound is below the last of
the item's best ``top`` scores so far (the task carries them from segment to segment).

Items are asked in blocks of bounded size; the driver holds the terms of one block.
The index is stored in small row groups and read a segment at a time, so no task holds more of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surge.llm.batches import NOT_WORD, Texts, slices
from surge.llm.staging import setting, staged

#: A segment closes at so many documents or (document, term) pairs; a longer document is a segment of its own.
SEGMENT_DOCUMENTS, SEGMENT_PAIRS = 8192, 1 << 19
#: Bytes of item texts in a block, on average; an item is never cut.
BLOCK_BYTES = 4 << 20
#: Documents scored at once, before the bound is looked at again.
STEP = 256
#: Parts in which the tasks' best documents meet before they meet by item.
PARTS = 16
#: Bytes of a row group of the index, looked at after every segment: a reader holds one at a time, however long the file is.
GROUP_BYTES = 4 << 20
#: Spark's setting of the rows in a batch that goes to Python; segments go one by one.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
INDEX = "ids array<long>, lengths array<long>, terms array<string>, starts array<int>, docs array<int>, counts array<int>"


def words_of(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(document of each term, terms) of texts: lower-cased A-Z, runs of ASCII letters, digits and other characters."""
    texts = Texts(column)
    words = texts.words(NOT_WORD)
    ends = np.concatenate([[0], np.cumsum(words.ends - words.starts)]).astype(np.int64)
    letters = np.ascontiguousarray(texts.data[~NOT_WORD[texts.data]])
    each = pa.Array.from_buffers(pa.large_string(), len(words.starts), [None, pa.py_buffer(ends), pa.py_buffer(letters)])
    return np.repeat(np.arange(texts.n), np.diff(words.first)), each


def _segment(ids: list, lengths: list, parts: list) -> pa.RecordBatch:
    """One row: ``parts`` list (terms, document, count) by slice, with terms as an Arrow array."""
    names = pa.concat_arrays([p[0] for p in parts]).dictionary_encode()
    code = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    doc, count = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
    order = np.lexsort((doc, code))
    starts = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(names.dictionary)))])
    row = [pa.array(ids, pa.int64()), pa.array(np.concatenate(lengths), pa.int64()), names.dictionary.cast(pa.string()), pa.array(starts, pa.int32()),
           pa.array(doc[order], pa.int32()), pa.array(count[order], pa.int32())]
    return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in row],
                                      names=["ids", "lengths", "terms", "starts", "docs", "counts"])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The segments of all documents, written to the shared folder.

    Terms are the maximal runs of ASCII letters, digits and characters above U+007F, with A-Z lower-cased.  Null and
    empty texts have none.  Ids are integers or null; repeated rows are documents each; an empty table has no segments.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, parts, pairs = [], [], [], 0
        for batch in batches:
            for piece in slices(batch, "text"):
                doc, each = words_of(piece.column("text"))
                if ids and (len(ids) + piece.num_rows > SEGMENT_DOCUMENTS or pairs + len(doc) > SEGMENT_PAIRS):
                    yield _segment(ids, lengths, parts)
                    ids, lengths, parts, pairs = [], [], [], 0
                names = each.dictionary_encode()
                key = doc * max(len(names.dictionary), 1) + names.indices.to_numpy(zero_copy_only=False)
                pair, count = np.unique(key, return_counts=True)
                owner, code = np.divmod(pair, max(len(names.dictionary), 1))
                parts.append((names.dictionary.take(pa.array(code)), owner + len(ids), count))
                ids += piece.column("id").to_pylist()
                lengths.append(np.bincount(doc, minlength=piece.num_rows))
                pairs += len(pair)
        if ids:
            yield _segment(ids, lengths, parts)

    return staged(rows.mapInArrow(run, INDEX), "search-index", **{
        "parquet.block.size": str(GROUP_BYTES), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"})


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, term): the distinct terms of each item; rows that share an id are one item."""
    rows = items.select(F.col(f"`{id_col}`").cast("long").alias("item"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                owner, each = words_of(piece.column("text"))
                yield pa.RecordBatch.from_arrays([piece.column("item").take(pa.array(owner)), each.cast(pa.string())], names=["item", "term"])

    return rows.mapInArrow(run, "item long, term string").distinct()


def _lists(batch: pa.RecordBatch, name: str, row: int) -> pa.Array:
    return batch.column(name)[row].values


def _found(terms: pa.Array, asked: pa.Array) -> np.ndarray:
    """The place of each asked term among a segment's terms, -1 if it has none."""
    return pc.fill_null(pc.index_in(asked, value_set=terms), -1).to_numpy(zero_copy_only=False)


def document_frequencies(index: DataFrame, asked: list[str]) -> np.ndarray:
    """Documents that hold each asked term."""
    names = pa.array(asked, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(asked), dtype=np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                at = _found(_lists(batch, "terms", row), names)
                starts = _lists(batch, "starts", row).to_numpy()
                here = np.flatnonzero(at >= 0)
                total[here] += starts[at[here] + 1] - starts[at[here]]
        here = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(here.astype(np.int32)), pa.array(total[here])], names=["term", "df"])

    part = index.select("terms", "starts").mapInArrow(run, "term int, df long")
    df = np.zeros(len(asked), dtype=np.int64)
    for r in part.groupBy("term").agg(F.sum("df").alias("df")).collect():  # at most a row for each asked term
        df[r["term"]] = r["df"]
    return df


def presence_masks(bitmaps: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(group of each of n documents, presence of the terms by group) from one packed bitmap per term."""
    group = np.zeros(n, dtype=np.int64)
    for at in range(0, len(bitmaps), 48):  # so many bits of a mask at once
        mask = np.zeros(n, dtype=np.int64)
        for j, bits in enumerate(bitmaps[at:at + 48]):
            mask |= np.unpackbits(bits, count=n).astype(np.int64) << j
        mask = np.unique(mask, return_inverse=True)[1]
        group = np.unique(group * (mask.max(initial=0) + 1) + mask, return_inverse=True)[1]
    first = np.unique(group, return_index=True)[1]
    held = np.array([(bits[first >> 3] >> (7 - (first & 7)).astype(np.uint8)) & 1 for bits in bitmaps], dtype=bool).reshape(len(bitmaps), len(first))
    return group, held


class Best:
    """The ``top`` best documents of an item: higher score, then smaller id, null ids last."""

    def __init__(self, top: int):
        self.top, self.score, self.id, self.bare = top, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """A score below this is out."""
        return int(self.score[-1]) if len(self.score) == self.top else 1

    def add(self, score: np.ndarray, ids: np.ndarray, bare: np.ndarray) -> None:
        keep = score >= max(self.least, 1)
        score, ids, bare = (np.concatenate([a, b[keep]]) for a, b in ((self.score, score), (self.id, ids), (self.bare, bare)))
        order = np.lexsort((ids, bare, -score))[:self.top]
        self.score, self.id, self.bare = score[order], ids[order], bare[order]


class Segment:
    """The asked terms of one index row: postings, contributions and packed bitmaps, each made when first used."""

    def __init__(self, batch: pa.RecordBatch, row: int, asked: pa.Array, n: int, total: int):
        self.at = _found(_lists(batch, "terms", row), asked)
        self.starts, self.docs, self.counts, length = (_lists(batch, c, row).to_numpy() for c in ("starts", "docs", "counts", "lengths"))
        ids = _lists(batch, "ids", row)
        self.bare = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
        m = [50 + 50 * int(x) * n // total for x in length] if int(length.max(initial=0)) * n > 1 << 55 else 50 + 50 * length * n // max(total, 1)
        self.norm = 20 * np.array(m, dtype=np.int64)
        self.made: dict[int, tuple] = {}

    def term(self, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(documents, contributions, bitmap, largest contribution) of an asked term that the segment has."""
        if t not in self.made:
            here = slice(self.starts[self.at[t]], self.starts[self.at[t] + 1])
            doc, tf = self.docs[here], self.counts[here].astype(np.int64)
            gain = 1_000_000_000 * tf // (1000 * tf + self.norm[doc])
            bits = np.zeros(len(self.ids), dtype=bool)
            bits[doc] = True
            self.made[t] = doc, gain, np.packbits(bits), int(gain.max())
        return self.made[t]

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> int:
        """Add the documents that an item's terms rank; returns how many were scored."""
        terms = terms[(self.at[terms] >= 0) & (weights[terms] > 0)]
        if not len(terms):
            return 0
        held = [self.term(t) for t in terms.tolist()]
        weight = weights[terms]
        if int(weight @ np.array([h[3] for h in held], dtype=np.int64)) < best.least:
            return 0
        group, present = presence_masks([h[2] for h in held], len(self.ids))
        bound = (weight * np.array([h[3] for h in held], dtype=np.int64)) @ present
        turn = np.argsort(-bound, kind="stable")
        size = np.bincount(group, minlength=len(bound))[turn]
        upto = np.concatenate([[0], np.cumsum(size)])
        place = np.empty(len(turn), dtype=np.int64)
        place[turn] = np.arange(len(turn))
        by_turn = np.argsort(place[group], kind="stable")  # documents by descending bound of their groups
        at = scored = 0
        while at < len(turn) and bound[turn[at]] >= best.least:
            end = max(int(np.searchsorted(upto, upto[at] + STEP, side="right")) - 1, at + 1)
            end = max(at + 1, at + int((bound[turn[at:end]] >= best.least).sum()))
            rows = np.sort(by_turn[upto[at]:upto[end]])
            score = np.zeros(len(rows), dtype=np.int64)
            for w, (doc, gain, _, _) in zip(weight.tolist(), held, strict=True):
                spot = np.searchsorted(doc, rows)
                spot[spot == len(doc)] = 0
                hit = doc[spot] == rows
                score[hit] += w * gain[spot[hit]]
            best.add(score, self.ids[rows], self.bare[rows])
            scored += len(rows)
            at = end
        return scored


def _rank(index: DataFrame, asked: list[str], weights: np.ndarray, items: list[tuple], n: int, total: int, top: int) -> DataFrame:
    """(item, doc, score): the best ``top`` documents of each item in each task."""
    names = pa.array(asked, pa.string())
    lists = [(item, np.array(terms, dtype=np.int64)) for item, terms in items]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in lists]
        for batch in batches:
            for row in range(batch.num_rows):
                segment = Segment(batch, row, names, n, total)
                for (_, terms), found in zip(lists, best, strict=True):
                    segment.search(terms, weights, found)
        for (item, _), found in zip(lists, best, strict=True):
            if len(found.score):
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(found.score), pa.int64()), pa.array(found.id, mask=found.bare), pa.array(found.score)],
                                                 names=["item", "doc", "score"])

    return index.mapInArrow(run, "item long, doc long, score long")


def search(index: DataFrame, items: DataFrame, top: int = 50, id_col: str = "item_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` best documents with a score above 0, from ``build_index``.

    Weight w of a term: floor(1000 * ln((2N + 2) / (2df + 1))), with N the documents that hold a term.  A document of n terms
    has m = 50 + (50 * n * N) div L, with L the terms of all; it scores the sum of w * ((10**9 * tf) div (1000 * tf + 20 * m)).
    Equal scores go by ascending id, null ids last.  Rows that share an item id are one item with the terms of all; an item
    without terms (null, empty) has no rows; repeated documents are ranked each; empty tables give an empty result.
    """
    spark = index.sparkSession
    said = index.select(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("l"),
                        F.size(F.filter("lengths", lambda x: x > 0)).alias("n")).agg(F.sum("n"), F.sum("l")).first()
    n, total = (int(x or 0) for x in said)
    asked = staged(item_terms(items, id_col, text_col), "search-items")
    size = asked.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    blocks = -(-size // block_bytes)
    parts = []
    for b in range(blocks if n else 0):
        mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
        names = [r[0] for r in mine.select("term").distinct().orderBy("term").collect()]  # one block: bounded by block_bytes
        number = {t: i for i, t in enumerate(names)}
        terms = [(r[0], sorted(number[t] for t in r[1])) for r in mine.groupBy("item").agg(F.collect_list("term")).collect()]
        if not terms:
            continue
        with setting(spark, BATCH_ROWS, "1"):
            df = document_frequencies(index, names)
            weights = np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64)
            parts.append(staged(_rank(index, names, weights, terms, n, total, top), "search-best"))
    best = spark.createDataFrame([], "item long, doc long, score long") if not parts else parts[0]
    for part in parts[1:]:
        best = best.unionAll(part)
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    dealt = best.withColumn("part", F.pmod(F.xxhash64("doc"), F.lit(PARTS)))
    near = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")
