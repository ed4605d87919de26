"""Token-id output: concatenated ids with Elias-Fano document borders.

The table of a corpus is cut into segments by ascending document id; each
segment is one row of the file set (Parquet as container, written by Spark's
commit protocol, so a lost executor leaves no half file):

``part, seq``   place of the segment: range partition, then running number
``n_docs, n_tokens``  its size
``doc_ids``     ids of its documents, ascending (null first)
``ids``         little-endian unsigned ids (``id_bytes`` each), documents end to end
``low_bits, low, high, samples``  the end offset of every document, Elias-Fano coded

With u tokens and n documents an end offset takes 2 + ceil(log2(u / n)) bits
plus a sample of the high part's select structure every ``SAMPLE`` ones; no
64-bit offset table exists.  A second small table holds the tokens before each
range partition, so that offsets are global.

Nulls and empty texts are documents that hold only the end id.  Rows that
share a document id stay separate documents, in the order of their text's
hash.  An empty table gives an empty file set.  Columns other than id and text
are not read.
"""

from __future__ import annotations

import gc
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surge.llm.staging import shared_path

SAMPLE = 256
#: A segment is closed after so many tokens (one longer document is one segment).
SEGMENT_TOKENS = 1 << 20
#: Units kept per worker in each of two cache generations; a longer unit than so many bytes is not kept.
CACHE_UNITS, KEPT_BYTES = 500_000, 64
#: Units that go to the tokenizer as one text.
TOGETHER = 4096
#: A unit that has no white space but one leading space.
LINE = re.compile(r" ?\S+")
#: The letters by which byte-level BPE vocabularies spell bytes (printable ones themselves, others from U+0100 on).
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}

SEGMENTS = ("part int, seq int, n_docs int, n_tokens long, doc_ids array<long>, id_bytes int, ids binary, "
            "low_bits int, low binary, high binary, samples array<int>")


# --- Elias-Fano -----------------------------------------------------------

def ef_encode(ends: np.ndarray) -> tuple[int, bytes, bytes, np.ndarray]:
    """Code a non-decreasing sequence: (bits of the low part, low, high, select samples)."""
    n = len(ends)
    top = int(ends[-1]) if n else 0
    bits = max(0, (top // n).bit_length() - 1) if n and top >= n else 0
    low = (ends[:, None] >> np.arange(bits, dtype=np.int64)) & 1 if bits else np.zeros((n, 0), np.int64)
    at = (ends >> bits) + np.arange(n, dtype=np.int64)
    high = np.zeros(int(at[-1]) + 1 if n else 0, dtype=np.uint8)
    high[at] = 1
    return (bits, np.packbits(low.astype(np.uint8).ravel(), bitorder="little").tobytes(),
            np.packbits(high, bitorder="little").tobytes(), at[::SAMPLE].astype(np.int32))


def ef_select(i: int, bits: int, low: bytes, high: bytes, samples: np.ndarray) -> int:
    """The i-th value, read from the nearest sample on; no other value is decoded."""
    at = int(samples[i // SAMPLE])
    seen = i // SAMPLE * SAMPLE
    byte = at >> 3
    word = high[byte] >> (at & 7) << (at & 7)
    while True:
        ones = word.bit_count()
        if seen + ones > i:
            for _ in range(i - seen):
                word &= word - 1
            at = byte * 8 + (word & -word).bit_length() - 1
            break
        seen += ones
        byte += 1
        word = high[byte]
    first = i * bits
    chunk = int.from_bytes(low[first >> 3:(first + bits + 7) >> 3], "little") >> (first & 7)
    return (at - i) << bits | chunk & ((1 << bits) - 1)


def ef_decode(n: int, bits: int, low: bytes, high: bytes) -> np.ndarray:
    """All values at once, for scans."""
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(high, np.uint8), bitorder="little"))[:n].astype(np.int64)
    upper = ones - np.arange(n, dtype=np.int64)
    if not bits:
        return upper
    got = np.unpackbits(np.frombuffer(low, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return upper << bits | got.astype(np.int64) @ (np.int64(1) << np.arange(bits, dtype=np.int64))


# --- encoding -------------------------------------------------------------

#: Classes of bytes: everything else, letters, digits, signs (no apostrophe: contractions), space, line feed.
OTHER, LETTER, DIGIT, SIGN, BLANK, FEED = range(6)
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[33:127] = SIGN
_CLASS[39] = OTHER
_CLASS[48:58] = DIGIT
_CLASS[65:91] = _CLASS[97:123] = LETTER
_CLASS[32], _CLASS[10] = BLANK, FEED
#: One-byte characters that are not white space; first bytes of the two-byte ones from U+00C0 on, none of which is.
_SOLID = np.zeros(256, dtype=bool)
_SOLID[33:127] = True
_LEAD = np.zeros(256, dtype=bool)
_LEAD[0xC3:0xE0] = True
#: Second bytes of the letters among U+00C0-U+00FF (all but the signs of multiplication and division).
_LATIN = np.zeros(256, dtype=bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False


def unit_starts(data: np.ndarray, offs: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """First bytes of the units of texts (borders ``offs``): parts that a byte-level BPE tokenizer encodes independently.

    A text is cut before a single space between two characters that are no white space.  A piece of letters, digits, signs, spaces and
    line feeds is cut further, where the tokenizer cuts: at changes of class, a space going with what follows, white space
    before its last character.  A piece with other characters stays one unit, and so do texts in ``whole``."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)

    def before(x: np.ndarray) -> np.ndarray:
        out = np.zeros(n, dtype=x.dtype)
        out[1:] = x[:-1]
        return out

    def behind(x: np.ndarray) -> np.ndarray:
        out = np.zeros(n, dtype=x.dtype)
        out[:-1] = x[1:]
        return out

    kind, solid, lead = _CLASS[data], _SOLID[data], _LEAD[data]
    latin = (data == 0xC3) & _LATIN[behind(data)]
    kind[latin | before(latin)] = LETTER
    first = np.zeros(n + 1, dtype=bool)
    first[offs[:-1][np.diff(offs) > 0]] = True
    first[n] = True
    heads, tails = first[:-1], first[1:]
    border = (data == 32) & before(solid | before(lead)) & behind(solid | lead) & ~heads & ~tails
    if whole.any():
        inside = np.zeros(n + 1, dtype=np.int32)
        np.add.at(inside, offs[:-1][whole], 1)
        np.add.at(inside, offs[1:][whole], -1)
        inside = np.cumsum(inside[:-1]) > 0
        border &= ~inside
        kind[inside] = OTHER
    piece = border | heads
    at = np.flatnonzero(piece)
    odd = np.repeat(np.add.reduceat((kind == OTHER).astype(np.int32), at) > 0, np.diff(np.concatenate([at, [n]])))
    white = (kind == BLANK) | (kind == FEED)
    run = ~white & (kind != before(kind)) & ~(before(kind == BLANK) & ~heads)
    gap = white & ~(before(white) & ~heads)
    last = white & behind(~white) & ~tails  # stands alone or leads what follows
    return np.flatnonzero(piece | ((run | gap | last) & ~odd))


def byte_level(said: dict) -> bool:
    """Whether a tokenizer's description is a byte-level BPE with the usual cuts and no normaliser: else units are not independent."""
    cut, model = said.get("pre_tokenizer") or {}, said.get("model") or {}
    changes = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    return (said.get("normalizer") is None and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
            and model.get("type") == "BPE" and not any(model.get(k) for k in changes))


class PieceEncoder:
    """Ids of texts, each distinct unit encoded once while it is cached.

    Texts are cut into units as one byte array; the distinct units of a batch are looked up, their ids taken by the units' codes and
    laid end to end by Arrow, so there is no Python loop per word.  With a tokenizer that is not a plain byte-level BPE, and for
    texts that hold a special token, the whole text goes to the library.
    """

    def __init__(self, tokenizer_file: str, kind: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        if kind == "<u2" and self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("this vocabulary has more than 65,536 ids: id_bytes must be 4")
        self.kind = kind
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = byte_level(json.loads(self.tokenizer.to_str()))
        self.feed = self.tokenizer.token_to_id(BYTE_LETTERS[10])
        self.fresh: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, dtype=self.kind).tobytes()

    def _learn(self, units: list[bytes]) -> list[bytes]:
        """Ids of new units.  Those without inner white space are lines of one text: a line feed between them is a token of
        its own, and what follows it begins anew."""
        said = [u.decode() for u in units]
        out: list[bytes | None] = [None] * len(units)
        lines = [i for i, s in enumerate(said) if LINE.fullmatch(s)] if self.feed is not None else []
        for at in range(0, len(lines), TOGETHER):
            mine = lines[at:at + TOGETHER]
            ids = np.frombuffer(self._whole("\n".join([said[i] for i in mine])), dtype=self.kind)
            cuts = np.flatnonzero(ids == self.feed) * ids.itemsize
            raw = ids.tobytes()
            for i, a, b in zip(mine, [0, *(cuts + ids.itemsize).tolist()], [*cuts.tolist(), len(raw)], strict=True):
                out[i] = raw[a:b]
        return [self._whole(s) if got is None else got for s, got in zip(said, out, strict=True)]

    def _ids(self, units: list[bytes]) -> list[bytes]:
        if len(self.fresh) > CACHE_UNITS:
            self.old, self.fresh = self.fresh, {}
        fresh, old = self.fresh, self.old
        out = []
        for u in units:
            got = fresh.get(u)
            if got is None and (got := old.get(u)) is not None:
                fresh[u] = got
            out.append(got)
        new = [i for i, got in enumerate(out) if got is None]
        for i, got in zip(new, self._learn([units[i] for i in new]), strict=True):
            out[i] = got
            if len(units[i]) <= KEPT_BYTES:
                fresh[units[i]] = got
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.plain:
            return [self._whole(t) for t in texts]
        column = pa.array(texts, pa.large_string())
        _, offsets, raw = column.buffers()
        offs = np.frombuffer(offsets, dtype=np.int64)[:len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = np.frombuffer(raw, dtype=np.uint8)[:offs[-1]] if raw is not None else np.zeros(0, np.uint8)
        whole = np.array([any(s in t for s in self.special) for t in texts], dtype=bool)
        starts = unit_starts(data, offs, whole)
        if not len(starts):
            return [b""] * len(texts)
        border = pa.py_buffer(np.concatenate([starts, [len(data)]]).astype(np.int64))
        units = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, border, pa.py_buffer(data)]).dictionary_encode()
        coded = self._ids(units.dictionary.to_pylist())
        size = np.array([len(x) for x in coded], dtype=np.int64)[units.indices.to_numpy(zero_copy_only=False)]
        flat = pa.array(coded, pa.large_binary()).take(units.indices).buffers()[2].to_pybytes()
        edge = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(starts, offs)].tolist()
        return [flat[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]


#: Encoders of this worker process: tasks that follow one another share the caches.
_ENCODERS: dict[tuple[str, str], PieceEncoder] = {}


def _encoder(tokenizer_file: str, kind: str) -> PieceEncoder:
    if (tokenizer_file, kind) not in _ENCODERS:
        _ENCODERS[tokenizer_file, kind] = PieceEncoder(tokenizer_file, kind)
    return _ENCODERS[tokenizer_file, kind]


def encode_segments(docs: DataFrame, id_col: str, text_col: str, tokenizer_file: str, end_id: int,
                    id_bytes: int = 2, partitions: int | None = None) -> DataFrame:
    """The segments of a corpus, one row each, in the layout above.

    Rows are range-partitioned by (id, hash of the text): whole texts move once,
    as they are smaller than their ids, and the hash spreads the rows of an id
    that very many rows share.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    rows = rows.withColumn("_tie", F.xxhash64("_text"))
    rows = rows.repartitionByRange(n, "_id", "_tie").sortWithinPartitions("_id", "_tie", "_text")
    rows = rows.withColumn("_part", F.spark_partition_id()).select("_part", "_id", "_text")
    kind = {2: "<u2", 4: "<u4"}[id_bytes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # the caches are many small objects without cycles
        encoder = _encoder(tokenizer_file, kind)
        end = np.array([end_id], dtype=kind).tobytes()
        part, seq = None, 0
        ids: list[bytes] = []
        doc_ids: list = []
        size = 0

        def close() -> pa.RecordBatch:
            ends = np.cumsum([len(x) // id_bytes for x in ids], dtype=np.int64)
            bits, low, high, samples = ef_encode(ends)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int32()),
                pa.array([int(ends[-1])], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())),
                pa.array([id_bytes], pa.int32()), pa.array([b"".join(ids)], pa.binary()),
                pa.array([bits], pa.int32()), pa.array([low], pa.binary()), pa.array([high], pa.binary()),
                pa.array([samples.tolist()], pa.list_(pa.int32()))],
                names=["part", "seq", "n_docs", "n_tokens", "doc_ids", "id_bytes", "ids",
                       "low_bits", "low", "high", "samples"])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                cut = batch.slice(at, 512)
                if part is None:
                    part = cut.column(0)[0].as_py()
                coded = encoder.encode([t or "" for t in cut.column(2).to_pylist()])
                for doc_id, got in zip(cut.column(1).to_pylist(), coded, strict=True):
                    ids.append(got + end)
                    doc_ids.append(doc_id)
                    size += len(ids[-1]) // id_bytes
                    if size >= SEGMENT_TOKENS:
                        yield close()
                        seq, size, ids, doc_ids = seq + 1, 0, [], []
        if ids:
            yield close()

    return rows.mapInArrow(run, SEGMENTS)


def write_corpus(docs: DataFrame, path: str, id_col: str, text_col: str, tokenizer_file: str, end_id: int,
                 id_bytes: int = 2, partitions: int | None = None) -> str:
    """Write the file set below ``path``: ``segments`` and ``bases`` (tokens and documents before each range partition)."""
    spark = docs.sparkSession
    encode_segments(docs, id_col, text_col, tokenizer_file, end_id, id_bytes, partitions) \
        .write.option("compression", "zstd").parquet(f"{path}/segments")
    parts = spark.read.schema(SEGMENTS).parquet(f"{path}/segments").groupBy("part").agg(
        F.sum("n_tokens").alias("tokens"), F.sum(F.col("n_docs").cast("long")).alias("docs"))
    # One row per range partition, so the running sum runs over a table of partitions, not of rows.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0))).coalesce(1).write.parquet(f"{path}/bases")
    return path


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Segments with ``start``: the tokens of all segments before them."""
    segments = spark.read.schema(SEGMENTS).parquet(f"{path}/segments")
    bases = spark.read.schema("part int, tokens long, docs long, base long").parquet(f"{path}/bases")
    before = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)  # three numbers a segment
    at = segments.select("part", "seq", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("within")) \
        .join(bases.select("part", "base"), "part").select("part", "seq", (F.col("base") + F.col("within")).alias("start"))
    return segments.join(at, ["part", "seq"])


def document_index(segments: DataFrame) -> DataFrame:
    """One row per document of the file set: id, global start, length and crc32 of its ids as 32-bit values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                r = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                wide = np.frombuffer(r["ids"], {2: "<u2", 4: "<u4"}[r["id_bytes"]]).astype("<u4")
                ends = ef_decode(r["n_docs"], r["low_bits"], r["low"], r["high"])
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                view = memoryview(wide.tobytes())
                crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(starts + r["start"], pa.int64()),
                     pa.array(ends - starts, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    cols = segments.select("n_docs", "doc_ids", "id_bytes", "ids", "low_bits", "low", "high", "start")
    return cols.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_round_trip(docs: DataFrame, tokenizer_file: str, end_id: int = 2, id_col: str = "doc_id",
                          text_col: str = "text", id_bytes: int = 2) -> DataFrame:
    """Encode, write to the shared folder, read back: one row per document."""
    spark = docs.sparkSession
    path = write_corpus(docs, shared_path(spark, "tokens"), id_col, text_col, tokenizer_file, end_id, id_bytes)
    return document_index(read_corpus(spark, path))
