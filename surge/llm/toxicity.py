"""Toxicity with noisy-channel deobfuscation.

1. A character trigram model is counted over the words of all documents.
2. A token that may be disguised (look-alikes beside letters, marks between
   them, repetitions, letters set apart by spaces) becomes a lattice: every
   character may stand for itself, for the letters it imitates, for nothing (a
   mark), for a repetition or, a gap between spaced letters, for a word border.  Viterbi finds the likeliest letter string under
   the channel costs and the character model.
3. The restored text is scored: evidence weights of words and word beginnings,
   learned from labelled rows, feed a logistic model of three document features.

Counting works on byte arrays (see batches); only disguised tokens are decoded
one by one, each distinct one once per task while it is cached.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surge.llm.batches import SPACE, Texts, mix64, slices
from surge.llm.staging import staged

#: Letters that a sign or digit imitates, by habit of writers.
LOOKALIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "l", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c", "¡": "i", "ß": "b", "µ": "u",
}
MARKS = ".-_*~'`^,:;/\\#%&\"=​­·"
#: Costs (natural log) of the channel: imitation, mark left out, repetition left out, sign lost, gap of a spaced run as word border.
COST = {"swap": 1.0, "mark": 0.5, "repeat": 0.2, "lost": 7.0, "gap": 0.5}
#: Longest token that is decoded as one; longer ones are decoded in overlapping stretches of this length.
STRETCH = 64
CACHE_TOKENS = 200_000

# Symbols of the character model: 0 border, 1-26 letters, 27-58 bytes of other letters, 59 the rest.
SYMBOLS = 60
_SYMBOL = np.full(256, 59, dtype=np.int64)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[128:] = 27 + (np.arange(128, 256) & 31)
_SYMBOL[[9, 10, 11, 12, 13, 32]] = 0

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_NOT_LETTER = ~_LETTER

#: One-byte signs that imitate a letter or are put between letters.
_SIGN = np.zeros(256, dtype=bool)
_SIGN[[ord(c) for c in [*LOOKALIKE, *MARKS] if ord(c) < 128]] = True
#: One-byte signs that imitate a letter; those that also close a sentence count only between letters, or before them.
_LOOK = np.zeros(256, dtype=bool)
_LOOK[[ord(c) for c in LOOKALIKE if ord(c) < 128]] = True
_CLOSES = np.zeros(256, dtype=bool)
_CLOSES[[ord(c) for c in "!("]] = True
_TOKEN_GAP = SPACE.copy()
_TOKEN_GAP[ord("|")] = True

BEGINNINGS = (4, 5, 6)


# --- character model --------------------------------------------------------

def character_counts(docs: DataFrame, text_col: str) -> np.ndarray:
    """Trigram counts of symbols over all words of all documents (a table of fixed size)."""
    cells = SYMBOLS ** 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, dtype=np.int64)
        for batch in batches:
            for piece in slices(batch, "text"):
                texts = Texts(piece.column("text"))
                s = _SYMBOL[texts.data]
                if len(s) == 0:
                    continue
                s = np.concatenate([[0], s, [0]])
                code = (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]
                total += np.bincount(code, minlength=cells)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    out = np.zeros(cells, dtype=np.float64)
    got = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "cell long, n long") \
        .groupBy("cell").agg(F.sum("n").alias("n")).collect()  # at most SYMBOLS ** 3 rows
    for r in got:
        out[r["cell"]] = r["n"]
    return out.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """Interpolated log P(c | a, b)."""
    pair, one = counts.sum(axis=0), counts.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + SYMBOLS)
    p2 = (pair + 5 * p1) / (pair.sum(axis=1, keepdims=True) + 5)
    p3 = (counts + 5 * p2[None]) / (counts.sum(axis=2, keepdims=True) + 5)
    return np.log(p3).astype(np.float32)


# --- restoring --------------------------------------------------------------

class Restorer:
    """Viterbi over character lattices."""

    def __init__(self, logp: np.ndarray):
        self.logp = logp.tolist()
        self.cache: dict[str, str] = {}

    @staticmethod
    def _symbol(ch: str) -> int:
        raw = ch.encode()
        return int(_SYMBOL[raw[0]]) if len(raw) == 1 else int(_SYMBOL[raw[-1]])

    def options(self, token: str) -> list[list[tuple[str, float]]]:
        """For each position: (letter or nothing, cost).  Runs of one character are one position."""
        out: list[list[tuple[str, float]]] = []
        at = 0
        while at < len(token):
            ch = token[at]
            end, run, gaps = at + 1, 1, 0
            while ch != " " and (token[end:end + 1] == ch or token[end:end + 2] == " " + ch):
                gaps += token[end] == " "
                end += 1 + (token[end] == " ")
                run += 1
            if ch == " ":
                out.append([("", 0.0), (" ", COST["gap"])])
            elif ch.isalpha() and ch not in LOOKALIKE:
                out.append([(ch, 0.0 if run == 1 else COST["repeat"] * run)])
                if run == 2:
                    out[-1] = [(ch + ch, 0.0), (ch, 2 * COST["repeat"])]
                elif run > 2:
                    out[-1].append((ch + ch, COST["repeat"] * run))
                if gaps:
                    out[-1].append((ch + " " + ch, COST["gap"] + COST["repeat"] * (run - 2)))
            elif ch in LOOKALIKE:
                near = [(x, COST["swap"]) for x in LOOKALIKE[ch]]
                if run >= 2:
                    near += [(x + x, 2 * COST["swap"]) for x in LOOKALIKE[ch]]
                if ch.isalpha():
                    near.append((ch * run, 0.0))
                else:
                    near.append(("", COST["lost"]))
                out.append(near + [(x + " " + x, 2 * COST["swap"] + COST["gap"]) for x in LOOKALIKE[ch] if gaps])
            else:
                out.append([("", COST["mark"])])
            at = end
        return out

    def decode(self, token: str) -> str:
        logp = self.logp
        beams: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        for choices in self.options(token):
            after: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (cost, said) in beams.items():
                for letters, price in choices:
                    x, y, total = a, b, cost + price
                    for ch in letters:
                        z = self._symbol(ch)
                        total -= logp[x][y][z]
                        x, y = y, z
                    had = after.get((x, y))
                    if had is None or total < had[0]:
                        after[(x, y)] = (total, said + letters)
            beams = after
        end = min(((cost - logp[a][b][0], said) for (a, b), (cost, said) in beams.items()), default=(0.0, ""))
        return end[1]

    def restore(self, token: str) -> str:
        """The likeliest letters behind a token."""
        token = token.lower()
        had = self.cache.get(token)
        if had is None:
            if len(self.cache) > CACHE_TOKENS:
                self.cache.clear()
            core = token.strip(MARKS + " ")
            most = 2 * STRETCH if " " in core else STRETCH
            if len(core) <= most:
                had = self.decode(core)
            else:
                step = most // 2
                had = " ".join(self.decode(core[i:i + most]) for i in range(0, len(core) - step, step))
            self.cache[token] = had
        return had


def disguised(texts: Texts) -> tuple[np.ndarray, list[str]]:
    """(document, token) of the tokens that may be disguised: a sign between letters, look-alikes beside letters, a letter
    twice over, or three and more single characters set apart (as one token with its spaces)."""
    data = texts.data
    tokens = texts.words(_TOKEN_GAP)
    starts, ends = tokens.starts, tokens.ends
    if len(starts) == 0:
        return np.zeros(0, dtype=np.int64), []
    doc = np.repeat(np.arange(texts.n), np.diff(tokens.first))
    letter, sign, look = _LETTER[data], _SIGN[data], _LOOK[data]
    before, after = np.concatenate([[False], sign[:-1]]), np.concatenate([sign[1:], [False]])
    first, last = np.flatnonzero(sign & ~before), np.flatnonzero(sign & ~after)
    inside = (first > 0) & (last + 1 < len(data))
    first, last = first[inside], last[inside]
    at = [first[letter[first - 1] & letter[last + 1]]]
    if len(data) > 1:
        at.append(np.flatnonzero((data[:-1] == data[1:]) & letter[:-1] & (data[:-1] < 128)))
    signed = sign[starts]
    runs = np.flatnonzero(sign & ~after)
    lead = runs[np.searchsorted(runs, starts[signed])]  # last sign of a leading run
    at.append(starts[signed][(lead + 1 < ends[signed]) & letter[np.minimum(lead + 1, len(data) - 1)]])
    upto = np.concatenate([[0], np.cumsum(look & ~_CLOSES[data])]), np.concatenate([[0], np.cumsum(letter)])
    looks, letters = (x[ends] - x[starts] for x in upto)
    at.append(starts[(looks > 0) & (letters > 0)])
    found = np.searchsorted(starts, np.unique(np.concatenate(at)), side="right") - 1
    found = np.unique(found[found >= 0])
    # A run of signs may reach over a border of tokens: then no token holds it, and the token found ends before it.
    out_doc, out = [doc[found]], [data[a:b].tobytes().decode("utf-8", "replace")
                                  for a, b in zip(starts[found].tolist(), ends[found].tolist(), strict=True)]
    single = (ends - starts == 1) & (letter | sign)[starts]
    together = np.concatenate([[False], single[1:] & single[:-1] & (doc[1:] == doc[:-1])])
    head = np.flatnonzero(single & ~together)
    tail = np.flatnonzero(single & ~np.concatenate([together[1:], [False]]))
    long = tail - head >= 2
    out_doc.append(doc[head[long]])
    out += [" ".join(map(chr, data[starts[i:j + 1]].tolist())) for i, j in zip(head[long].tolist(), tail[long].tolist(), strict=True)]
    return np.concatenate(out_doc), out


# --- features ---------------------------------------------------------------

@dataclass(frozen=True)
class Evidence:
    """(document, feature) pairs with repeats, words per document, restored tokens per document."""

    doc: np.ndarray
    code: np.ndarray
    words: np.ndarray
    restored: list[str]

    def among(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, position in the sorted ``codes``)."""
        if not len(codes) or not len(self.code):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(codes, self.code), len(codes) - 1)
        hit = codes[at] == self.code
        both = np.unique(self.doc[hit] * np.int64(len(codes)) + at[hit])
        return both // len(codes), both % len(codes)


def evidence(column: pa.Array, restorer: Restorer) -> Evidence:
    """Hashes of words and of their beginnings, of the texts and of their restored tokens."""
    texts = Texts(column)
    owner, found = disguised(texts)
    said: list[list[str]] = [[] for _ in range(texts.n)]
    for d, token in zip(owner.tolist(), found, strict=True):
        said[d].append(restorer.restore(token))
    restored = [" ".join(x) for x in said]
    docs, codes, count = [], [], np.zeros(texts.n, dtype=np.int64)
    for part in (texts, Texts(pa.array(restored, pa.large_string()))):
        words = part.words(_NOT_LETTER)
        doc = np.repeat(np.arange(part.n), np.diff(words.first))
        count += np.diff(words.first)
        docs.append(doc)
        codes.append(words.hashes())
        starts, ends = words.starts, words.ends
        for n in BEGINNINGS:
            long = ends - starts > n
            words.starts, words.ends = starts[long], starts[long] + n
            docs.append(doc[long])
            codes.append(mix64(words.hashes() + np.uint64(n)))
            words.starts, words.ends = starts, ends
    return Evidence(np.concatenate(docs), np.concatenate(codes), count, restored)


@dataclass(frozen=True)
class Model:
    logp: np.ndarray
    codes: np.ndarray    # sorted feature hashes
    weights: np.ndarray
    coef: np.ndarray     # intercept and three document features

    def document_features(self, got: Evidence) -> np.ndarray:
        """(1, largest weight, log of 1 + sum, distinct hits per word) per document."""
        n = len(got.words)
        out = np.zeros((n, 4))
        out[:, 0] = 1
        doc, at = got.among(self.codes)
        if len(doc):
            w = self.weights[at]
            np.maximum.at(out[:, 1], doc, w)
            out[:, 2] = np.log1p(np.bincount(doc, w, minlength=n))
            out[:, 3] = np.bincount(doc, minlength=n) / np.maximum(got.words, 1)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.coef, -30, 30)))


def _evidence(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> tuple[np.ndarray, np.ndarray]:
    """(log-odds weight, log-likelihood ratio) of features seen in so many toxic and clean rows."""
    p, q = (toxic + 0.1) / (n_toxic + 0.2), (clean + 0.1) / (n_clean + 0.2)
    all_ = (toxic + clean + 0.1) / (n_toxic + n_clean + 0.2)

    def ll(k: np.ndarray, n: int, x: np.ndarray) -> np.ndarray:
        return k * np.log(x) + (n - k) * np.log1p(-np.minimum(x, 1 - 1e-9))

    g = 2 * (ll(toxic, n_toxic, p) + ll(clean, n_clean, q) - ll(toxic, n_toxic, all_) - ll(clean, n_clean, all_))
    return np.log(p / q), g


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Ridge-penalised Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + 0.1 * w
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w - np.linalg.solve(h, grad)
    return w


def _share(ident: Column) -> Column:
    return F.pmod(F.xxhash64(ident, F.lit("toxicity sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", sample_rows: int = 40_000) -> DataFrame:
    """(id, text columns of docs, label) of about ``sample_rows`` labelled rows, drawn by the hash of their id before they meet their texts.

    The drawn labels are bounded by ``sample_rows`` and broadcast; no text moves but those of the sample, which is written once."""
    known = labels.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{label_col}`").alias(label_col)).where(F.col(label_col).isin(0, 1))
    rate = min(1.0, sample_rows / max(known.count(), 1))
    drawn = known.where(_share(F.col(id_col)) < rate)
    return staged(docs.drop(label_col).where(_share(F.col(f"`{id_col}`")) < rate).join(F.broadcast(drawn), id_col), "toxicity-sample")


def fit(docs: DataFrame, labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", id_col: str = "doc_id",
        sample_rows: int | None = 40_000, least_docs: int = 8, least_ratio: float = 35.0) -> Model:
    """Learn the character model from all ``docs`` and the scorer from ``labelled`` rows (text, 0/1 label).

    ``sample_rows`` bounds, in expectation, the labelled rows the scorer is fitted
    on, drawn by the hash of their id; rows without a label are left out.  None: ``labelled`` is a bounded sample already.
    """
    logp = log_probabilities(character_counts(docs, text_col))
    rows = labelled.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                           F.col(f"`{label_col}`").cast("int").alias("label")).where("label IN (0, 1)")
    n = rows.count()
    if sample_rows is not None:
        rows = rows.where(_share(F.col("id")) < min(1.0, sample_rows / max(n, 1)))
    rows = rows.select("label", "text")

    def seen(keep: np.ndarray | None):
        """Counts of features per label; all of toxic rows, or those in ``keep`` of all rows."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            restorer = Restorer(logp)
            for batch in batches:
                for piece in slices(batch, "text"):
                    got = evidence(piece.column("text"), restorer)
                    if keep is None:
                        pairs = np.unique(np.stack([got.code.view(np.int64), got.doc]), axis=1)
                        code, doc = pairs[0], pairs[1]
                    else:
                        doc, at = got.among(keep)
                        code = keep[at].view(np.int64)
                    label = piece.column("label").to_numpy(zero_copy_only=False)[doc].astype(np.int64)
                    value, times = np.unique(np.stack([code, label]), axis=1, return_counts=True) \
                        if len(code) else (np.zeros((2, 0), np.int64), np.zeros(0, np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(value[0]), pa.array(value[1]), pa.array(times)], names=["code", "label", "n"])
        return run

    sums = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    n_toxic, n_clean = sums.get(1, 0), sums.get(0, 0)
    kind = "code long, label long, n long"
    frequent = rows.where("label = 1").mapInArrow(seen(None), kind).groupBy("code").agg(F.sum("n").alias("n")) \
        .where(F.col("n") >= least_docs).select("code").collect()  # at most the features of sample_rows rows / least_docs
    keep = np.sort(np.array([r["code"] for r in frequent], dtype=np.int64).view(np.uint64))
    empty = Model(logp, np.zeros(0, np.uint64), np.zeros(0), np.array([math.log((n_toxic + 0.5) / (n_clean + 0.5)) if n else -3.0, 0, 0, 0]))
    if not len(keep) or not n_clean:
        return empty
    clean = {r["code"]: r["n"] for r in rows.mapInArrow(seen(keep), kind).groupBy("code", "label").agg(F.sum("n").alias("n"))
             .groupBy("code").pivot("label", [0, 1]).agg(F.first("n")).selectExpr("code", "struct(coalesce(`0`, 0) c, coalesce(`1`, 0) t) n").collect()}
    codes = np.array(sorted(clean), dtype=np.int64)
    t = np.array([clean[c]["t"] for c in codes.tolist()], dtype=float)
    c = np.array([clean[x]["c"] for x in codes.tolist()], dtype=float)
    weight, ratio = _evidence(t, c, n_toxic, n_clean)
    good = (ratio >= least_ratio) & (t > c) & (weight > 0)
    codes, weight = codes[good].view(np.uint64), weight[good]
    order = np.argsort(codes)
    draft = Model(logp, codes[order], weight[order], np.zeros(4))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(logp)
        for batch in batches:
            for piece in slices(batch, "text"):
                x = draft.document_features(evidence(piece.column("text"), restorer))
                yield pa.RecordBatch.from_arrays([piece.column("label"), *[pa.array(x[:, j]) for j in (1, 2, 3)]],
                                                 names=["label", "a", "b", "c"])

    got = rows.mapInArrow(measured, "label int, a double, b double, c double").toPandas()  # sample_rows short rows
    x = np.column_stack([np.ones(len(got)), got[["a", "b", "c"]].to_numpy()])
    return Model(logp, draft.codes, draft.weights, _logistic(x, got["label"].to_numpy(dtype=float)))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with (toxicity, restored) behind its columns: score 0 to 1, and the restored disguised tokens.

    Null and empty texts score as texts without evidence.  The two names replace
    columns that already bear them; an empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c not in ("toxicity", "restored")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model.logp)
        for batch in batches:
            for piece in slices(batch, "text"):
                got = evidence(piece.column("text"), restorer)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("row"), pa.array(model.score(model.document_features(got))), pa.array(got.restored, pa.string())],
                    names=["row", "toxicity", "restored"])

    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("toxicity", T.DoubleType()),
                           T.StructField("restored", T.StringType())])
    done = rows.mapInArrow(run, schema)
    return done.select(*[F.col("row").getField(c).alias(c) for c in kept], "toxicity", "restored")
