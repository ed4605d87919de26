"""Language identification by nearest centroid.

A text is the normalised TF-IDF vector of its byte 2- and 3-grams, hashed to
``DIMS`` columns.  Every language has several centroids, found by spherical
k-means on a bounded sample of its labelled rows; a text takes the language of
the centroid with the largest cosine and is rejected when that cosine is below
half of what 98 % of the language's own texts of this length reach.  Short texts
have few grams and lower cosines, so the reach is learned for lengths that double,
from pieces of the sample's rows, by centroids that were fitted without the row.
Document frequencies cover all rows that may be learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surge.llm.batches import LOWER, NOT_WORD, Texts, mix64, slices

DIMS = 4096
#: Documents turned into dense vectors at once.
BLOCK = 256
#: Bytes of the pieces that the reach of a language is measured on; between them it is interpolated over the logarithm.
LENGTHS = 2 ** np.arange(2, 13)
_CODES = np.where(NOT_WORD, 32, LOWER).astype(np.uint64)


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    langs: list[str]
    centroids: np.ndarray  # rows of unit length
    owner: np.ndarray      # index into langs
    floor: np.ndarray      # (language, length): cosine that 98 % of its own texts of this length reach


def _counts(texts: Texts) -> np.ndarray:
    """Dense (document, column) counts of byte 2- and 3-grams."""
    out = np.zeros(texts.n * DIMS, dtype=np.float32)
    data, offs = _CODES[texts.data], texts.offs
    doc = np.repeat(np.arange(texts.n, dtype=np.int64), np.diff(offs))
    for n in (2, 3):
        if len(data) < n:
            continue
        m = len(data) - n + 1
        code = np.uint64(n)
        for j in range(n):
            code = code * np.uint64(256) + data[j:m + j]
        same = doc[:m] == doc[n - 1:]
        column = (mix64(code) >> np.uint64(40)).astype(np.int64) % DIMS
        out += np.bincount((doc[:m] * DIMS + column)[same], minlength=len(out)).astype(np.float32)
    return out.reshape(texts.n, DIMS)


def _blocks(batch: pa.RecordBatch, text: str) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, counts) of the batch, ``BLOCK`` documents at a time."""
    at = 0
    for piece in slices(batch, text):
        for start in range(0, piece.num_rows, BLOCK):
            cut = piece.slice(start, BLOCK)
            yield at + start, _counts(Texts(cut.column(text)))
        at += piece.num_rows


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.maximum(norm, 1e-12)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids; starts from farthest-first rows, so it is repeatable."""
    picked = [x[int(np.argmax(x @ x.mean(axis=0)))]]
    while len(picked) < min(k, len(x)):
        near = np.max(x @ np.array(picked).T, axis=1)
        picked.append(x[int(np.argmin(near))])
    c = np.array(picked)
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        for j in range(len(c)):
            if (own == j).any():
                m = x[own == j].mean(axis=0)
                c[j] = m / max(float(np.linalg.norm(m)), 1e-12)
    return c


def reach(texts: list[str], x: np.ndarray, idf: np.ndarray, centroids: int) -> np.ndarray:
    """For each of ``LENGTHS`` the cosine that 98 % of pieces of that size reach; ``x`` holds the vectors of ``texts``.

    Pieces of one half of the rows meet the centroids of the other half.  A length that
    no row has takes the value of the next shorter one; a single row has no reach (0),
    and ``fit`` gives its language the least reach of the others.
    """
    raw = [t.encode() for t in texts]
    half = np.arange(len(raw)) % 2
    fitted = [spherical_kmeans(x[half != h], centroids) if (half != h).any() else None for h in (0, 1)]
    out, last = np.zeros(len(LENGTHS)), 0.0
    for j, size in enumerate(LENGTHS.tolist()):
        near = []
        for h in (0, 1):
            rows = [i for i in range(h, len(raw), 2) if len(raw[i]) >= size]
            if fitted[h] is None or not rows:
                continue
            at = mix64(np.array(rows, dtype=np.uint64) + np.uint64(size)) % np.array([len(raw[i]) - size + 1 for i in rows], dtype=np.uint64)
            pieces = [raw[i][a:a + size].decode("utf-8", "ignore") for i, a in zip(rows, at.tolist(), strict=True)]
            batch = pa.RecordBatch.from_arrays([pa.array(pieces, pa.large_string())], names=["text"])
            near += [np.max(vectors(c, idf) @ fitted[h].T, axis=1) for _, c in _blocks(batch, "text")]
        if near:
            last = float(np.quantile(np.concatenate(near), 0.02))
        out[j] = max(last, 0.0)
    return out


def fit(labelled: DataFrame, text_col: str, lang_col: str, id_col: str, centroids: int = 4,
        sample_per_language: int = 1500) -> Model:
    """Learn from rows with a language; others are left out.

    ``sample_per_language`` bounds, in expectation, the rows of a language that
    its centroids are fitted on: a row is in the sample by the hash of its id.
    Document frequencies and label counts cover all rows.
    """
    rows = labelled.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"),
                           F.col(f"`{id_col}`").alias("id")).where("lang is not null")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIMS, dtype=np.int64), 0
        for batch in batches:
            for _, counts in _blocks(batch, "text"):
                total += (counts > 0).sum(axis=0)
                n += len(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS + 1)), pa.array(np.append(total, n))], names=["col", "df"])

    df = {r["col"]: r["df"] for r in rows.select("text").mapInArrow(frequencies, "col long, df long")
          .groupBy("col").agg(F.sum("df").alias("df")).collect()}  # DIMS + 1 rows
    n = df.get(DIMS, 0)
    idf = np.log((1 + n) / (1 + np.array([df.get(c, 0) for c in range(DIMS)], dtype=np.float64))).astype(np.float32)
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language
    if not sizes:
        return Model(idf, [], np.zeros((0, DIMS), np.float32), np.zeros(0, int), np.zeros((0, len(LENGTHS))))
    rate = F.create_map(*[F.lit(v) for lang, m in sizes.items() for v in (lang, min(1.0, sample_per_language / m))])
    u = F.pmod(F.xxhash64("id", F.lit("language sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where(u < F.element_at(rate, F.col("lang"))).select("lang", "text")

    def learn(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        batch = pa.RecordBatch.from_pandas(group[["text"]].sort_values("text"), preserve_index=False)
        x = np.concatenate([vectors(c, idf) for _, c in _blocks(batch, "text")])
        some = np.abs(x).sum(axis=1) > 0
        x = x[some]
        if not len(x):
            return pd.DataFrame({"lang": [], "centroid": [], "floor": []})
        c = spherical_kmeans(x, centroids)
        texts = [t for t, ok in zip(batch.column("text").to_pylist(), some.tolist(), strict=True) if ok]
        floor = reach(texts, x, idf, centroids).tolist()
        return pd.DataFrame({"lang": key[0], "centroid": [v.astype(np.float32).tobytes() for v in c], "floor": [floor] * len(c)})

    got = sample.groupBy("lang").applyInPandas(learn, "lang string, centroid binary, floor array<double>").collect()
    got = sorted(got, key=lambda r: (r["lang"], r["centroid"]))  # centroids x languages rows
    langs = sorted({r["lang"] for r in got})
    floors = {r["lang"]: r["floor"] for r in got}
    floor = np.array([floors[x] for x in langs]).reshape(-1, len(LENGTHS))
    known = floor.any(axis=1)
    if known.any():
        floor[~known] = floor[known].min(axis=0)
    return Model(idf, langs, np.array([np.frombuffer(r["centroid"], np.float32) for r in got]).reshape(-1, DIMS),
                 np.array([langs.index(r["lang"]) for r in got], dtype=int), floor)


def identify(docs: DataFrame, model: Model, text_col: str = "text", slack: float = 0.5) -> DataFrame:
    """``docs`` with (lang_pred, lang_score, rejected) behind its columns.

    ``lang_score`` is the largest cosine (0 to 1).  A text that is null or has no
    letter is ``und`` with score 0 and rejected; another is rejected when its cosine
    is below ``slack`` times that which 98 % of its language's texts of this length
    reach (lengths outside ``LENGTHS`` count as the nearest of them).  With
    nothing learned every text is ``und``.  The three names replace columns that
    already bear them; an empty table gives an empty result.
    """
    out = ["lang_pred", "lang_score", "rejected"]
    kept = [c for c in docs.columns if c not in out]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text_col}`").alias("text"),
                       F.coalesce(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.lit(False)).alias("letters"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            best, owner = np.zeros(n), np.zeros(n, dtype=int)
            if len(model.langs):
                for at, counts in _blocks(batch, "text"):
                    near = vectors(counts, model.idf) @ model.centroids.T
                    top = near.argmax(axis=1)
                    best[at:at + len(near)] = np.clip(near[np.arange(len(near)), top], 0, 1)
                    owner[at:at + len(near)] = model.owner[top]
            letters = batch.column("letters").to_numpy(zero_copy_only=False).astype(bool)
            if len(model.langs):
                names = np.array(model.langs, dtype=object)[owner]
                size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
                size = np.log2(np.maximum(size, 1))
                floor = np.zeros(n)
                for i, reached in enumerate(model.floor):
                    floor[owner == i] = np.interp(size[owner == i], np.log2(LENGTHS), reached)
                rejected = ~letters | (best < slack * floor)
            else:
                names, rejected = np.full(n, "und", dtype=object), np.ones(n, dtype=bool)
            names = np.where(letters, names, "und")
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(names, pa.string()), pa.array(np.where(letters, best, 0.0)), pa.array(rejected)],
                names=["row", *out])

    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("lang_score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    done = rows.mapInArrow(run, schema)
    return done.select(*[F.col("row").getField(c).alias(c) for c in kept], *out)

