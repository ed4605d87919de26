"""Benchmark decontamination: BM25 with block-max WAND, then question and answer overlap.

Test items are indexed: an inverted index of words with BM25 weights, each item's
weights divided by the score it gives itself, so that a passage holding every word
of an item scores 1.  Documents are read as passages, windows of words that overlap
by half; items are grouped by length so that any item fits into half a window of its
group.  Each item's rarest words, as many as leave at most ``REST`` of its score to the
others, are its essential words: for all windows of a slice at once, the weights of the
essential words found, plus the item's rest, bound the score.  Windows whose bound
reaches the threshold for any item are searched by block-max WAND, which returns every
item at or above it.  A hit counts when enough of the question's and of the answer's
word shingles stand in the passage.

The index is cut into blocks of bounded bytes; every block meets all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surge.llm.batches import NOT_WORD, Texts, slices

K1, B = 1.2, 0.75
#: Bytes of item text in an index block, in expectation: what a task holds of the items at a time.
INDEX_BYTES = 4 << 20
#: Words of the shortest group's longest item; further groups double it.
SHORTEST = 64
#: Largest share of an item's score that its other words may have.
REST = 0.3
#: Postings per block of the block-max index.
BLOCK = 32


@dataclass
class Index:
    """Items of one block; all arrays are sorted by term, then item."""

    items: list            # item ids by position
    span: int              # longest item in words (group bound)
    terms: np.ndarray      # sorted term hashes
    begin: np.ndarray      # postings of term t: begin[t]:begin[t + 1]
    item: np.ndarray
    weight: np.ndarray
    largest: np.ndarray    # largest weight of a term
    rest: np.ndarray       # per item: share of its score that its other words have
    key_terms: np.ndarray  # sorted hashes of essential words
    key_begin: np.ndarray
    key_item: np.ndarray
    key_weight: np.ndarray
    block_item: list       # per term: last item of each block of postings
    block_max: list        # per term: largest weight in each block
    question: list         # per item: (k, distinct shingle hashes)
    answer: list

    def search(self, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """Every (item, score) with score >= threshold, by block-max WAND over the given distinct terms."""
        cur = [[int(self.begin[t]), int(self.begin[t + 1]), int(t)] for t in terms]
        found = []
        item, weight, eps = self.item, self.weight, 1e-9
        while cur:
            cur.sort(key=lambda c: item[c[0]])
            bound, pivot = 0.0, -1
            for i, c in enumerate(cur):
                bound += self.largest[c[2]]
                if bound >= threshold - eps:
                    pivot = i
                    break
            if pivot < 0:
                break
            target = item[cur[pivot][0]]
            while pivot + 1 < len(cur) and item[cur[pivot + 1][0]] == target:
                pivot += 1
            # The blocks that hold the target give a closer bound than the whole lists.
            close, next_item = 0.0, np.iinfo(np.int64).max
            for c in cur[:pivot + 1]:
                b = int(np.searchsorted(self.block_item[c[2]], target))
                if b < len(self.block_item[c[2]]):
                    close += self.block_max[c[2]][b]
                    next_item = min(next_item, self.block_item[c[2]][b] + 1)
            if close >= threshold - eps:
                if item[cur[0][0]] == target:
                    score = sum(weight[c[0]] for c in cur[:pivot + 1])
                    if score >= threshold - eps:
                        found.append((int(target), float(score)))
                    goal = target + 1
                else:
                    goal = target
            else:
                goal = next_item if pivot + 1 >= len(cur) else min(next_item, item[cur[pivot + 1][0]])
                goal = max(goal, target + 1)
            for c in cur[:pivot + 1]:
                c[0] += int(np.searchsorted(item[c[0]:c[1]], goal))
            cur = [c for c in cur if c[0] < c[1]]
        return found


def _sentences(text: str) -> tuple[str, str]:
    """(question, answer): the last sentence or line is the answer; an item of one sentence has none."""
    body = text.rstrip()
    ends = [i + 1 for i, ch in enumerate(body[:-1]) if ch in ".?!\n" and (ch == "\n" or body[i + 1].isspace())]
    for cut in reversed(ends):
        if any(c.isalnum() for c in body[cut:]) and any(c.isalnum() for c in body[:cut]):
            return body[:cut], body[cut:]
    return body, ""


def _word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    words = Texts(pa.array([t.lower() for t in texts], pa.large_string())).words(NOT_WORD)
    return words.hashes(), words.first


def _shingle_sets(texts: list[str], n: int) -> list[tuple[int, np.ndarray]]:
    """(k, distinct shingles of k words) of each text; k is n, or the words of a shorter text."""
    words, first = _word_hashes(texts)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        k = min(n, b - a)
        out.append((k, Texts.shingle_codes(words[a:b], k) if k else words[:0]))
    return out


def build_index(rows: list[tuple], frequency: dict[int, int], n_items: int, mean_words: float, span: int, n: int) -> Index:
    """Index of (item_id, text) rows; ``frequency``: items that hold a term, of all ``n_items`` items."""
    texts = [t for _, t in rows]
    words, first = _word_hashes(texts)
    owner = np.repeat(np.arange(len(rows)), np.diff(first))
    length = np.diff(first)
    order = np.lexsort((owner, words))
    words, owner = words[order], owner[order]
    new = np.ones(len(words), dtype=bool)
    new[1:] = (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])
    start = np.flatnonzero(new)
    tf = np.diff(np.append(start, len(words))).astype(float)
    words, owner = words[start], owner[start]
    terms, begin, df_at = np.unique(words, return_index=True, return_inverse=True)
    df = np.array([frequency[int(t)] for t in terms.view(np.int64).tolist()], dtype=float)[df_at]
    weight = np.log1p((n_items - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[owner] / max(mean_words, 1)))
    own = np.bincount(owner, weight, minlength=len(rows))
    weight = weight / own[owner]
    begin = np.append(begin, len(words))
    rare = np.lexsort((words, -weight, df, owner))  # an item's words, rarest first
    upto = np.cumsum(weight[rare])
    upto -= np.repeat((upto - weight[rare])[np.flatnonzero(np.diff(owner[rare], prepend=-1))], np.bincount(owner)[np.unique(owner)])
    key = rare[upto - weight[rare] < 1 - REST]
    rest = 1 - np.bincount(owner[key], weight[key], minlength=len(rows))
    key = key[np.lexsort((owner[key], words[key]))]
    key_terms, key_begin = np.unique(words[key], return_index=True)
    lists = [(owner[a:b], weight[a:b]) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]
    cut = [_sentences(t) for t in texts]
    return Index([i for i, _ in rows], span, terms, begin, owner, weight,
                 np.maximum.reduceat(weight, begin[:-1]) if len(terms) else np.zeros(0),
                 rest, key_terms, np.append(key_begin, len(key)), owner[key], weight[key],
                 [o[np.minimum(np.arange(BLOCK - 1, len(o) + BLOCK - 1, BLOCK), len(o) - 1)] for o, _ in lists],
                 [np.maximum.reduceat(w, np.arange(0, len(w), BLOCK)) for _, w in lists],
                 _shingle_sets([q for q, _ in cut], n), _shingle_sets([a for _, a in cut], n))


class Passage:
    """Shingles of a window's words, by length."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.codes: dict[int, np.ndarray] = {}

    def share(self, part: tuple[int, np.ndarray]) -> float:
        """Share of a part's distinct shingles that stand in the window; 1 for a part without words."""
        k, codes = part
        if not k:
            return 1.0
        if k not in self.codes:
            self.codes[k] = Texts.shingle_codes(self.words, k)
        return float(np.isin(codes, self.codes[k], assume_unique=True).sum()) / len(codes)


def _hits(code: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, term) of the hashes that are among the sorted ``terms``."""
    seen = np.zeros(1 << 16, dtype=bool)
    seen[(terms >> np.uint64(48)).astype(np.int64)] = True
    maybe = np.flatnonzero(seen[(code >> np.uint64(48)).astype(np.int64)])
    at = np.minimum(np.searchsorted(terms, code[maybe]), len(terms) - 1)
    hit = terms[at] == code[maybe]
    return maybe[hit], at[hit]


def search_texts(column: pa.Array, index: Index, threshold: float, overlap: float) -> Iterator[tuple[int, int, float, float, float, int]]:
    """(document, item, score, question share, answer share, first word of the passage), the best passage of each pair."""
    words = Texts(column).words(NOT_WORD)
    code, first = words.hashes(), words.first
    if not len(code) or not len(index.terms):
        return
    position, term = _hits(code, index.key_terms)
    stride, width = index.span, 2 * index.span
    counts = np.diff(first)
    # Segment s of a document is half a window: window s has segments s and s + 1; the last may be shorter.
    windows = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - width) // stride)), 0)
    base = np.cumsum(windows) - windows
    doc = np.searchsorted(first, position, side="right") - 1
    times = index.key_begin[term + 1] - index.key_begin[term]
    posting = np.repeat(index.key_begin[term], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    doc, segment = np.repeat(doc, times), np.repeat((position - first[doc]) // stride, times)
    item, weight = index.key_item[posting], index.key_weight[posting]
    cells, weights = [], []
    for window in (segment - 1, segment):
        ok = (window >= 0) & (window < windows[doc])
        cells.append((base[doc] + window)[ok] * np.int64(len(index.items)) + item[ok])
        weights.append(weight[ok])
    cell, at = np.unique(np.concatenate(cells), return_inverse=True)
    bound = np.bincount(at, np.concatenate(weights), minlength=len(cell)) + index.rest[cell % len(index.items)]
    chosen = np.unique(cell[bound >= threshold - 1e-9] // len(index.items))
    best: dict[tuple[int, int], tuple[float, float, float, int]] = {}
    for w in chosen.tolist():
        d = int(np.searchsorted(base, w, side="right")) - 1
        a = int(first[d]) + (w - int(base[d])) * stride
        b = min(a + width, int(first[d + 1]))
        found = index.search(np.unique(_hits(code[a:b], index.terms)[1]), threshold)
        if not found:
            continue
        passage = Passage(code[a:b])
        for item, score in found:
            q, r = passage.share(index.question[item]), passage.share(index.answer[item])
            if q >= overlap and r >= overlap and (score, q + r) > best.get((d, item), (-1.0, 0, 0, 0))[:2]:
                best[d, item] = (score, q + r, q, a - int(first[d]))
    for (d, item), (score, both, q, start) in sorted(best.items()):
        yield d, item, score, q, both - q, start


def _blocks(items: DataFrame, n: int) -> Iterator[Index]:
    """Index blocks, one at a time on the driver; a block holds about ``INDEX_BYTES`` of text, or one longer item."""
    signs = r"[\x00-/:-@\[-`{-\x7f]+"
    words = F.size(F.filter(F.split(F.lower("text"), signs), lambda w: w != ""))
    rows = items.where("text IS NOT NULL").select("item", "text").distinct().withColumn("n", words).where("n > 0")
    group = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / F.lit(float(SHORTEST))))).cast("int")
    rows = rows.withColumn("group", group)
    totals = rows.groupBy("group").agg(F.count(F.lit(1)).alias("items"), F.sum("n").alias("words"),
                                       F.sum(F.octet_length("text")).alias("bytes")).orderBy("group").collect()  # one row a doubling
    n_items, n_words = sum(r["items"] for r in totals), sum(r["words"] for r in totals)

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                code, first = _word_hashes([t or "" for t in piece.column("text").to_pylist()])
                doc = np.repeat(np.arange(piece.num_rows), np.diff(first))
                pairs = np.unique(np.stack([doc, code.view(np.int64)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[1])], names=["term"])

    frequencies = rows.select("text").mapInArrow(terms, "term long").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    for total in totals:
        parts = -(-total["bytes"] // INDEX_BYTES)
        of_group = rows.where(F.col("group") == total["group"])
        for part in range(parts):
            block = of_group.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part)
            texts = [(r["item"], r["text"]) for r in block.select("item", "text").collect()]
            if not texts:
                continue
            texts.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
            own = block.select("text").mapInArrow(terms, "term long").distinct()
            df = {r["term"]: r["df"] for r in frequencies.join(own, "term", "left_semi").collect()}  # terms of the block
            yield build_index(texts, df, n_items, n_words / n_items, SHORTEST << total["group"], n)


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.6, overlap: float = 0.5, shingle: int = 5,
                 id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap, passage_start), one row for each document and item that meet.

    ``threshold``: least share of the item's own BM25 score; ``overlap``: least share of the question's, and of the
    answer's, distinct shingles found in the passage (words are lower-cased runs of letters and digits; an item of
    one sentence has no answer to find).  Null, empty and wordless texts on either side meet nothing; items that
    share an id count as one, with its best score; rows that share a document id likewise.  Empty tables give an
    empty result; other columns are not read.
    """
    spark = docs.sparkSession
    kind = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, passage_start long"
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.lower(F.col(f"`{text_col}`")).alias("text"))
    found = []
    for index in _blocks(items.select(F.col(f"`{item_col}`").cast("long").alias("item"), F.col(f"`{item_text_col}`").alias("text")), shingle):
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            for batch in batches:
                for piece in slices(batch, "text"):
                    hits = list(search_texts(piece.column("text"), index, threshold, overlap))
                    if hits:
                        d, item, *rest = zip(*hits, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [piece.column("doc_id").take(pa.array(d)), pa.array([index.items[i] for i in item], pa.int64()),
                             *[pa.array(x, pa.float64()) for x in rest[:3]], pa.array(rest[3], pa.int64())],
                            names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "passage_start"])

        found.append(rows.mapInArrow(run, kind))
    if not found:
        return spark.createDataFrame([], kind)
    best = F.max(F.struct("score", "question_overlap", "answer_overlap", F.negative("passage_start").alias("at"))).alias("best")
    return reduce(DataFrame.unionAll, found).groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.score", "best.question_overlap", "best.answer_overlap",
        F.negative("best.at").alias("passage_start"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` without the documents that hold a test item; columns unchanged."""
    gone = contaminated(docs, items, id_col=id_col, text_col=text_col, **how).select(F.col("doc_id").alias("_leak_id")).distinct()
    return docs.join(gone, F.col(f"`{id_col}`").eqNullSafe(F.col("_leak_id")), "left_anti")
