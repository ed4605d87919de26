"""Exact n-gram Jaccard join by blocked sparse products.

Documents are rows, n-grams columns of a 0/1 incidence matrix; A A' holds the
overlap of every pair.  Only the part that can matter is multiplied:

* Documents with equal n-gram sets are one row (their class; smallest id stands for it).
* Sizes bound a pair: rows of similarity t differ in at most D columns, D from their sizes.  Of D + 3 parts into which the
  columns are dealt by hash at least three are then equal; and they share one of their rarest columns, as many as t allows
  to differ, and one.  High similarities (few, wide parts) bundle the rows with an equal part; others bundle those with a rare
  column in common, rarity taken from a count sketch over all rows, so rows that only share a common passage do not meet.
  Pairs that met in a column of few rows are told apart first by bitmaps of their columns' parities, which differ in no more places.
  Sizes must allow t as well; all other pairs are below the bound.
* Bundles too large for a tile are dealt again, by the equal parts of another dealing.
* Bundles are cut into tiles of bounded size, and each pair of tiles whose sizes allow
  t is multiplied in one task (texts move there, as they are smaller than their sets), row by row: overlap counts accumulate
  for one row's partners, and pairs below the size-derived bound go at once.  A tile pair sends out
  the links it found as a forest, never its pairs.

All links between different texts are found; components follow from the forests.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surge.llm.batches import Texts, blobs, distinct_sorted, lists, mix64, slices
from surge.llm.links import connected_components
from surge.llm.staging import staged

#: Bits of the rarity sketch's cells, parts in which its counts are added up; its size does not depend on the data.
CELL_BITS, CHUNKS = 22, 256
CELLS = 1 << CELL_BITS
#: N-grams in a tile (8 bytes each), pairs held before they are joined.
TILE, PAIRS = 2_400_000, 1 << 20
SALTS = 32
#: Bits of the bitmap of keys by which texts are left out before they move (8 MB).
KEY_BITS = 26
#: Salt of the first half of a set's signature; signatures that a task remembers.
SIGN, SEEN = 0x51ED, 1 << 20
#: Rows of a column from which on they are held together as a run; fewer are compared pair by pair.
FEW = 64
#: Columns of an average part from which on equal parts tell rows apart better than rare columns do: similarities above some 0.88.
PART_COLUMNS = 8


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct (document, shingle hash), sorted, of lower-cased (A-Z) words between ASCII white space."""
    texts = Texts(column)
    return (*distinct_sorted(*texts.words().shingles(k)), texts.n)


Sets = Callable[[pa.Array], tuple[np.ndarray, np.ndarray, int]]


def cells_of(code: np.ndarray) -> np.ndarray:
    return (code >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def rarity(rows: DataFrame, sets: Sets) -> np.ndarray:
    """A rank for every sketch cell, smaller for rarer columns, from counts over all rows (column ``text``)."""
    width = CELLS // CHUNKS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, dtype=np.int32)
        for batch in batches:
            for piece in slices(batch, "text"):
                _, code, _ = sets(piece.column("text"))
                np.add.at(total, cells_of(code), np.int32(1))
        if total.any():
            parts = [total[i * width:(i + 1) * width] for i in range(CHUNKS)]
            yield pa.RecordBatch.from_arrays(  # in as few bytes a count as a chunk's largest needs
                [pa.array(range(CHUNKS), pa.int32()), blobs([x.astype(np.min_scalar_type(int(x.max()))).tobytes() for x in parts])],
                names=["chunk", "counts"])

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, dtype=np.int64)
        for raw in group["counts"]:
            total += np.frombuffer(raw, f"u{len(raw) // width}")
        rank = np.floor(8 * np.log2(1 + total)).clip(0, 255).astype(np.uint8)
        return pd.DataFrame({"chunk": [key[0]], "ranks": [rank.tobytes()]})

    got = rows.select("text").mapInArrow(run, "chunk int, counts binary").groupBy("chunk").applyInPandas(add, "chunk int, ranks binary")
    out = np.zeros(CELLS, dtype=np.uint8)
    for r in got.collect():  # CHUNKS rows, CELLS bytes in all
        out[r["chunk"] * width:(r["chunk"] + 1) * width] = np.frombuffer(r["ranks"], np.uint8)
    return out


def rare_first(doc: np.ndarray, code: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Order of sorted (doc, code) by document, rarity and code: one sort of words that hold document, rank and place."""
    if len(doc) and int(doc[-1]) >= 1 << 24:
        return np.lexsort((code, ranks[cells_of(code)], doc))
    key = (doc.astype(np.uint64) << np.uint64(8) | ranks[cells_of(code)]) << np.uint64(32) | np.arange(len(doc), dtype=np.uint64)
    key.sort()
    return (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def split_sets(doc: np.ndarray, code: np.ndarray, count: int) -> list[np.ndarray]:
    """The set of each document, copied out of the arrays of its slice."""
    upto = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=count))])
    return [code[a:b].copy() for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]


def least_overlap(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """ceil(n * num / den)."""
    return -(-n * num // den)


def _unseen(sign: np.ndarray, seen: set[int]) -> np.ndarray:
    """The first row of each signature that is not yet in ``seen``, which grows up to some ``SEEN``."""
    first = np.zeros(len(sign), dtype=bool)
    first[np.unique(sign, return_index=True)[1]] = True
    first &= np.array([s not in seen for s in sign.tolist()], dtype=bool)
    if len(seen) < SEEN:
        seen.update(sign[first].tolist())
    return first


#: Columns of ``signed_batch`` behind its keys.
SIGNED = "n long, sig_a long, sig_b long, prefix array<long>"


def signed_batch(piece: pa.RecordBatch, sets: Sets, ranks: np.ndarray | None, num: int, den: int, keys: list[str], seen: set[int]) -> pa.RecordBatch:
    """(*keys, n, sig_a, sig_b, prefix) of a slice with a column text, as ``signatures`` has them; ``seen``: the signatures of its task so far."""
    doc, code, count = sets(piece.column("text"))
    n = np.bincount(doc, minlength=count).astype(np.int64)
    upto = np.concatenate([[0], np.cumsum(n)])
    sig = []
    for salt in (SIGN, 0xA5A5A5A5):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(code ^ np.uint64(salt)), dtype=np.uint64)])
        sig.append((total[upto[1:]] - total[upto[:-1]]).view(np.int64))
    if ranks is None:
        order, length = np.arange(len(doc)), np.zeros_like(n)
    else:
        order = rare_first(doc, code, ranks)
        first = _unseen(sig[0], seen)
        length = np.where(first & (den * n >= num * (n + 1)), n - least_overlap(n, num, den) + 1, 0)
    place = np.arange(len(doc)) - upto[doc]
    chosen = place < length[doc]
    return pa.RecordBatch.from_arrays(
        [*[piece.column(c) for c in keys], pa.array(n), *[pa.array(s) for s in sig], lists(code[order][chosen].view(np.int64), length)],
        names=[*keys, "n", "sig_a", "sig_b", "prefix"])


def signatures(rows: DataFrame, sets: Sets, ranks: np.ndarray | None, num: int, den: int, keys: list[str]) -> DataFrame:
    """(*keys, n, sig_a, sig_b, prefix): set size, 128-bit signature of the set, and the prefix of its columns
    rare first (empty without ``ranks``).  A task gives the prefix of equal sets once, as ``prefix_rows`` does."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for piece in slices(batch, "text"):
                yield signed_batch(piece, sets, ranks, num, den, keys, seen)

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keys)
    return rows.select(*dict.fromkeys([*keys, "text"])).mapInArrow(run, f"{kinds}, {SIGNED}")


def parities(rows: DataFrame, sets: Sets) -> DataFrame:
    """(node, n, bits): of each set (named by its ``sig_a``) the parity of the columns that fall on each of some n to 2n bits; ``rows``: (text).

    Two sets' bits differ in no more places than the sets in columns.  The bits are words of 64, as many as the next power of two, so
    the larger of two such maps can be folded to the size of the smaller."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                doc, code, count = sets(piece.column("text"))
                n = np.bincount(doc, minlength=count).astype(np.int64)
                upto = np.concatenate([[0], np.cumsum(n)])
                total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(code ^ np.uint64(SIGN)), dtype=np.uint64)])
                words = 1 << np.ceil(np.log2(np.maximum(n / 64, 1))).astype(np.int64)
                base = np.cumsum(words) - words
                place = mix64(code ^ np.uint64(0xB175)) & (64 * words[doc] - 1).astype(np.uint64)
                bits = np.zeros(int(words.sum()), dtype=np.uint64)
                np.bitwise_xor.at(bits, base[doc] + (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
                yield pa.RecordBatch.from_arrays([pa.array((total[upto[1:]] - total[upto[:-1]]).view(np.int64)), pa.array(n), lists(bits.view(np.int64), words)],
                                                 names=["node", "n", "bits"])

    return rows.select("text").mapInArrow(run, "node long, n long, bits array<long>").where("n > 0")


def near_pairs(pairs: DataFrame, bits: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose parities leave room for the similarity: sets that differ in more columns than it allows are told apart.

    ``bits``: (node, n, bits); a node that has several keeps a pair if one of them does."""
    def side(name: str) -> DataFrame:
        return bits.select(F.col("node").alias(name), F.col("n").alias(f"n{name}"), F.col("bits").alias(f"bits{name}")).hint("merge")

    def folded(x: Column, y: Column) -> Column:
        """x with no more words than y: those that fall together are added up."""
        def word(j: Column) -> Column:
            return F.aggregate(F.sequence(j, F.size(x) - 1, F.size(y)), F.lit(0).cast("long"), lambda s, i: s.bitwiseXOR(F.get(x, i)))

        return F.when(F.size(x) <= F.size(y), x).otherwise(F.transform(F.sequence(F.lit(0), F.size(y) - 1), word))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    x, y = folded(F.col("bitsa"), F.col("bitsb")), folded(F.col("bitsb"), F.col("bitsa"))
    apart = F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, v: s + v)
    # Sets of a and b columns at num / den differ in at most (a + b) * (den - num) / (den + num).
    return both.where(apart * (num + den) <= (F.col("na") + F.col("nb")) * (den - num)).select("a", "b")


def bundle_edges(postings: DataFrame, num: int, den: int, few: int = 0) -> DataFrame:
    """Edges (a, b) that hold together all rows which share a column and whose sizes allow the similarity.

    ``postings``: (tok, id, n).  The rows of a column stream by size; each run of sizes
    without a gap hangs under its first row, so a column sends out fewer edges than it has rows.  With ``few`` a column of at most
    so many different rows sends every pair whose sizes allow the similarity instead, which may be left out if told apart: ``sure`` is
    false on these, and a third column."""
    ordered = postings.repartition("tok").sortWithinPartitions("tok", "n", "id")

    def runs(tok: np.ndarray, n: np.ndarray, node: np.ndarray, last: tuple | None) -> tuple[np.ndarray, tuple]:
        """Pairs, and (column, size, head) of the last row, from those of the row before."""
        new = np.ones(len(tok), dtype=bool)
        new[1:] = (tok[1:] != tok[:-1]) | (den * n[:-1] < num * n[1:])
        carried = last is not None and last[0] == tok[0] and den * last[1] >= num * n[0]
        new[0] = not carried
        at = np.where(new, np.arange(len(tok)), -1)
        head_at = np.maximum.accumulate(at)
        head = np.where(head_at < 0, last[2] if carried else 0, node[np.maximum(head_at, 0)])
        return np.stack([head, node])[:, head != node], (tok[-1], n[-1], head[-1])

    def all_pairs(tok: np.ndarray, n: np.ndarray, node: np.ndarray) -> np.ndarray:
        out, i = [np.zeros((2, 0), np.int64)], np.arange(len(tok))
        for d in range(1, few):  # sizes ascend within a column: where one is too large, so are those behind it
            i = i[i + d < len(tok)]
            i = i[(tok[i] == tok[i + d]) & (den * n[i] >= num * n[i + d])]
            if not len(i):
                break
            out.append(np.sort(np.stack([node[i], node[i + d]])[:, node[i] != node[i + d]], axis=0))
        return np.concatenate(out, axis=1)

    def batch_of(pairs: np.ndarray, sure: bool) -> pa.RecordBatch:
        pairs = np.unique(pairs, axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1]), pa.array(np.full(pairs.shape[1], sure))], names=["a", "b", "sure"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, np.zeros((3, 0), np.int64)  # the last row that was sent in a run; rows of the last column that may go on
        for batch in _and_end(batches):
            rows = held if batch is None else np.concatenate([held, np.stack([batch.column(c).to_numpy() for c in ("tok", "n", "id")])], axis=1)
            again = np.zeros(rows.shape[1], dtype=bool)
            again[1:] = (rows[:, 1:] == rows[:, :-1]).all(axis=0)
            rows = rows[:, ~again]
            if not rows.shape[1]:
                continue
            tok = rows[0]
            border = np.flatnonzero(np.diff(tok, prepend=~tok[:1]) != 0)
            size = np.diff(np.append(border, len(tok)))
            many = size > few
            if last is not None and last[0] == tok[0]:
                many[0] = True
            stays = batch is not None and not many[-1]
            upto = int(border[-1]) if stays else len(tok)
            held = rows[:, upto:]
            some = np.repeat(many, size)[:upto]
            if some.any():
                pairs, last = runs(*rows[:, :upto][:, some], last)
                yield batch_of(pairs, True)
            if not some.all():
                yield batch_of(all_pairs(*rows[:, :upto][:, ~some]), False)

    return ordered.mapInArrow(run, "a long, b long, sure boolean").select("a", "b", *(["sure"] if few else [])).distinct()


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def prefix_rows(rows: DataFrame, sets: Sets, ranks: np.ndarray, num: int, den: int) -> DataFrame:
    """(tok, id, n): the prefix of each set (its rarest columns, as many as its size allows to differ, and one), as tokens for
    ``bundle_edges``; ``rows``: (text).  The id is the set's ``sig_a``, and a task sends equal sets out once (as far as it remembers
    ``SEEN`` of them), so a large group of copies is reduced before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for piece in slices(batch, "text"):
                doc, code, count = sets(piece.column("text"))
                n = np.bincount(doc, minlength=count).astype(np.int64)
                upto = np.concatenate([[0], np.cumsum(n)])
                total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(code ^ np.uint64(SIGN)), dtype=np.uint64)])
                sign = (total[upto[1:]] - total[upto[:-1]]).view(np.int64)
                first = _unseen(sign, seen)
                # A set that no larger one can be similar to has no similar smaller one either.
                length = np.where(first & (den * n >= num * (n + 1)), n - least_overlap(n, num, den) + 1, 0)
                order = rare_first(doc, code, ranks)
                chosen = np.arange(len(doc)) - upto[doc] < length[doc]
                yield pa.RecordBatch.from_arrays([pa.array(code[order][chosen].view(np.int64)), pa.array(sign[doc[chosen]]), pa.array(n[doc[chosen]])],
                                                 names=["tok", "id", "n"])

    return rows.select("text").mapInArrow(run, "tok long, id long, n long")


def part_rows(rows: DataFrame, sets: Sets, num: int, den: int, seed: int = 7) -> DataFrame:
    """(tok, id, n): the parts of each set, as tokens for ``bundle_edges``; ``rows``: (bundle, id, text).

    Sizes fall into classes that grow by den / num.  A pair whose smaller set is in class c differs in at most
    D(c) columns; both deal their columns into D(c) + 3 parts, the larger one also if it is in class c + 1.
    Of the three equal parts at most two are empty unless a set has more empty parts, so empty ones count only then.
    ``seed`` picks the dealing; every dealing keeps all links."""
    ratio = den / num

    def floor_of(c: np.ndarray) -> np.ndarray:
        return np.power(ratio, c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                doc, code, count = sets(piece.column("text"))
                n = np.bincount(doc, minlength=count).astype(np.int64)
                bundle = piece.column("bundle").to_numpy().astype(np.uint64)
                klass = np.floor(np.log(np.maximum(n, 1)) / np.log(ratio) + 1e-9).astype(np.int64)
                for of in (0, 1):
                    c = klass - of
                    top = floor_of(c + 2) * 1.0001 + 1  # above the sizes of classes c and c + 1, whatever the rounding of logarithms
                    parts = np.floor((den - num) / (den + num) * (top / ratio + top)).astype(np.int64) + 3
                    base = np.cumsum(parts) - parts
                    cell = base[doc] + (mix64(code + np.uint64(seed)) % parts[doc].astype(np.uint64)).astype(np.int64)
                    order = np.argsort(cell, kind="stable")
                    total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(code[order] ^ np.uint64(0xC0FFEE)), dtype=np.uint64)])
                    size = np.bincount(cell, minlength=int(parts.sum()))
                    upto = np.cumsum(size)
                    own = total[upto] - total[upto - size]
                    who = np.repeat(np.arange(count), parts)
                    empty = np.bincount(who[size == 0], minlength=count)
                    used = ((size > 0) | (empty > 2)[who]) & (n > 0)[who]
                    tok = mix64(mix64(own + (np.arange(len(own)) - base[who]).astype(np.uint64)) ^ mix64(bundle[who] + c[who].astype(np.uint64) * np.uint64(2)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(tok[used].view(np.int64)), piece.column("id").take(pa.array(who[used])), pa.array(n[who[used]])],
                        names=["tok", "id", "n"])

    return rows.select("bundle", "id", "text").mapInArrow(run, "tok long, id long, n long")


def with_texts(texts: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``keys`` with their texts.  The keys grow with the data, so they are never broadcast: one plan at every size."""
    return texts.join(keys.hint("merge"), on)


def sketched(texts: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``texts`` without most of the rows whose columns ``on`` are not in ``keys``; the rows of ``keys`` all stay, so a join gives the same.

    The keys set bits of a bitmap of ``2 ** KEY_BITS``, which is broadcast: its size does not grow with the keys.  Rows that meet a bit
    by chance stay too, the more the fuller the bitmap is."""
    def bit() -> Column:
        return F.pmod(F.xxhash64(*[F.col(c).cast(texts.schema[c].dataType) for c in on]), F.lit(1 << KEY_BITS))

    word, place = F.shiftright("_bit", 6), F.expr("cast(_bit & 63 AS int)")
    words = keys.select(bit().alias("_bit")).groupBy(word.alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place)).alias("bits"))
    parts = words.groupBy(F.shiftright("word", 6).alias("_part")).agg(F.map_from_entries(F.collect_list(F.struct(F.expr("word & 63"), "bits"))).alias("map")) \
        .select("_part", F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(F.element_at("map", i.cast("long")), F.lit(0))).alias("_words"))
    parts = staged(parts, "ngram-keys")
    found = texts.withColumn("_bit", bit()).join(F.broadcast(parts), F.shiftright("_bit", 12) == F.col("_part"))
    return found.where(F.call_function("bit_get", F.expr("_words[cast((_bit >> 6) & 63 AS int)]"), place) == 1).select(*texts.columns)


def sharper(members: DataFrame, texts: DataFrame, on: list[str], sets: Sets, num: int, den: int, tile: int) -> DataFrame:
    """``members`` (bundle, id, n, ...) with the bundles of more than ``tile`` n-grams split by the equal parts of another dealing.

    ``texts`` has the columns ``on`` and text; the result is written to the shared folder.  Without such bundles the texts are not read."""
    if num >= den:
        return members
    large = members.groupBy("bundle").agg(F.sum("n").alias("all")).where(F.col("all") > tile).select("bundle")
    if large.isEmpty():
        return members
    inside = members.join(large, "bundle", "left_semi")
    parts = part_rows(with_texts(texts, inside.select(*dict.fromkeys([*on, "id"]), "bundle"), on), sets, num, den, seed=101)
    again = connected_components(bundle_edges(parts, num, den)).select(F.col("node").alias("id"), F.col("component").alias("new"))
    split = inside.join(again, "id").withColumn("bundle", F.col("new")).select(*members.columns)
    return staged(members.join(large, "bundle", "left_anti").unionByName(split), "ngram-members")


def tile_keys(members: DataFrame, num: int, den: int, carry: tuple[str, ...] = (), tile: int | None = None) -> DataFrame:
    """Deal the members (bundle, id, n) to tile pairs: (id, key, side), one row for each tile pair a member is in.

    ``carry``: further columns to keep.

    A bundle of at most ``tile`` n-grams (``TILE`` if not given) is one tile.  A larger one is cut by size class (sizes in classes
    that are not neighbours cannot link) and, within a class, by hash into tiles of so many n-grams."""
    tile = tile or TILE
    sizes = members.groupBy("bundle").agg(F.sum("n").alias("all"))
    klass = F.floor(F.log(F.col("n")) / F.lit(float(np.log(den / num))) + F.lit(1e-9)).cast("int") if num < den else F.col("n").cast("int")
    rows = members.withColumn("class", klass)
    cuts = rows.groupBy("bundle", "class").agg(F.ceil(F.sum("n") / tile).cast("int").alias("tiles")) \
        .join(sizes.where(F.col("all") > tile), "bundle")
    near = cuts.select("bundle", F.explode(F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1)).alias("class"),
                       F.col("class").alias("of"), "tiles") \
        .groupBy("bundle", "class").agg(F.map_from_entries(F.collect_list(F.struct("of", "tiles"))).alias("tiles"))  # 3 entries at most
    dealt = rows.join(near, ["bundle", "class"], "left")
    own = F.element_at("tiles", F.col("class"))
    mine = F.pmod(F.xxhash64("id"), own).cast("int")

    def span(n: Column) -> Column:
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def name(c1: Column, t1: Column, c2: Column, t2: Column) -> Column:
        return F.concat_ws(".", c1, t1, c2, t2)

    none = F.lit(0)
    c = F.col("class")
    up, down = F.coalesce(F.element_at("tiles", c + 1), none), F.coalesce(F.element_at("tiles", c - 1), none)
    pairs = F.concat(
        F.transform(span(own), lambda t: F.struct(name(c, F.least(t, F.col("mine")), c, F.greatest(t, F.col("mine"))).alias("pair"),
                                                  F.when(t == F.col("mine"), 2).when(t > F.col("mine"), 0).otherwise(1).alias("side"))),
        F.transform(span(up), lambda t: F.struct(name(c, F.col("mine"), c + 1, t).alias("pair"), F.lit(0).alias("side"))),
        F.transform(span(down), lambda t: F.struct(name(c - 1, t, c, F.col("mine")).alias("pair"), F.lit(1).alias("side"))))
    one = F.array(F.struct(F.lit("").alias("pair"), F.lit(2).alias("side")))
    return dealt.withColumn("mine", mine).withColumn("to", F.explode(F.when(F.col("tiles").isNull(), one).otherwise(pairs))) \
        .select("id", *carry, F.concat_ws("/", F.col("bundle").cast("string"), "to.pair").alias("key"), F.col("to.side").alias("side"))


def linked_rows(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, num: int, den: int) -> np.ndarray:
    """Root of every row after joining all pairs (i of left, j of right) at least num / den similar.

    The product of the incidence blocks, row by row: the postings of a left row's columns are concatenated and counted, partners below
    the size-derived bound are discarded at once, so no more than one row of counts is held; found pairs are joined as they come."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    column = np.unique(np.concatenate(sets), return_inverse=True)[1]
    upto = np.concatenate([[0], np.cumsum(size)])
    place = np.full(len(sets), -1)
    place[right] = np.arange(len(right))
    owner = np.repeat(place, size)
    order = np.argsort(column, kind="stable")
    order = order[owner[order] >= 0]  # the entries of right, by column
    posting = owner[order]
    begin = np.searchsorted(column[order], np.arange(int(column.max(initial=-1)) + 2))
    root, mine, theirs, held = np.arange(len(sets)), [], [], 0
    sizes = size[right]
    for i in left.tolist():
        own = column[upto[i]:upto[i + 1]]
        start, count = begin[own], begin[own + 1] - begin[own]
        at = np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())
        both = np.bincount(posting[at], minlength=len(right))
        j = np.flatnonzero(both * (num + den) >= num * (size[i] + sizes))
        mine.append(np.full(len(j), i))
        theirs.append(right[j])
        held += len(j)
        if held > PAIRS:
            root, mine, theirs, held = forest(root, np.concatenate(mine), np.concatenate(theirs)), [], [], 0
    return forest(root, np.concatenate(mine), np.concatenate(theirs)) if held else root


def forest(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Root of every node after joining the given pairs, from the roots so far."""
    root = root.copy()
    while len(i):
        a, b = root[i], root[j]
        open_ = a != b
        if not open_.any():
            break
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def tile_links(tiles: DataFrame, sets_of: Sets, num: int, den: int) -> DataFrame:
    """Links (a, b) found by multiplying each tile pair; (id, text, key, side) in, a forest per tile pair out."""
    ordered = tiles.repartition("key").sortWithinPartitions("key", "id")

    def solve(ids: list[int], sets: list[np.ndarray], sides: list[int]) -> pa.RecordBatch | None:
        side = np.array(sides)
        if (side == 2).all():
            left = right = np.arange(len(ids))
        else:
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(left) or not len(right):
            return None
        root = linked_rows(sets, left, right, num, den)
        name = np.array(ids, dtype=np.int64)
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, root, name)
        a = least[root]
        moved = a != name
        return pa.RecordBatch.from_arrays([pa.array(a[moved]), pa.array(name[moved])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, sets, sides = None, [], [], []
        for batch in batches:
            for piece in slices(batch, "text"):
                found = split_sets(*sets_of(piece.column("text")))
                for k, i, s, w in zip(piece.column("side").to_pylist(), piece.column("id").to_pylist(), found,
                                      piece.column("key").to_pylist(), strict=True):
                    if w != key:
                        if len(ids) > 1 and (got := solve(ids, sets, sides)) is not None:
                            yield got
                        key, ids, sets, sides = w, [], [], []
                    ids.append(i)
                    sets.append(s)
                    sides.append(k)
        if len(ids) > 1 and (got := solve(ids, sets, sides)) is not None:
            yield got

    return ordered.select("key", "id", "text", "side").mapInArrow(run, "a long, b long").distinct()


def jaccard_components(docs: DataFrame, k: int, num: int, den: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id).

    Words are runs between ASCII white space, lower-cased A-Z; a text of 1 to k-1 words is one shingle; null, empty
    and blank texts have none and link with nothing.  Two texts link when ``den * overlap >= num * union``, exactly.
    ``component_id`` is the smallest id reachable.  Rows that share an id count as one document with several
    texts; rows with a null id take part in no link.  An empty table gives an empty result; other columns are not read.
    """
    def sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
        return shingle_sets(column, k)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    signed = staged(signatures(rows, sets, None, num, den, ["id"]).drop("prefix"), "ngram-signatures")
    sig = ["n", "sig_a", "sig_b"]
    classes = signed.where("n > 0 AND id IS NOT NULL").groupBy(*sig).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("size"))
    classes = staged(classes, "ngram-classes")
    if num < den:
        some = rows.where("id IS NOT NULL")
        if num + den >= 2 * PART_COLUMNS * (den - num):
            edges, by = bundle_edges(part_rows(some.withColumn("bundle", F.lit(0).cast("long")), sets, num, den), num, den), "id"
        else:
            # With many rows the sketch tells rare columns apart less and less, and rows meet that only share a passage.
            met = staged(bundle_edges(prefix_rows(some, sets, rarity(some, sets), num, den), num, den, FEW), "ngram-met")
            bits = staged(parities(some, sets).distinct(), "ngram-parities")
            edges, by = met.where("sure").select("a", "b").unionAll(near_pairs(met.where("NOT sure").select("a", "b"), bits, num, den)), "sig_a"
        bundles = connected_components(edges).select(F.col("node").alias(by), F.col("component").alias("bundle"))
        members = classes.select(F.col("rep").alias("id"), "n", "sig_a").join(bundles, by).groupBy("id", "bundle").agg(F.max("n").alias("n"))
        members = staged(members, "ngram-members")
        members = sharper(members, rows, ["id"], sets, num, den, TILE)
        several = members.groupBy("bundle").count().where("count > 1").select("bundle")
        members = staged(members.join(several, "bundle", "left_semi"), "ngram-several")
        keys = tile_keys(members, num, den)
        links = connected_components(tile_links(with_texts(sketched(rows, members, ["id"]), keys, ["id"]), sets, num, den))
    else:  # only equal sets are so similar, and those are one class
        links = bundle_edges(rows.limit(0).select(F.col("id").alias("tok"), "id", F.col("id").alias("n")), 1, 1) \
            .select(F.col("a").alias("node"), F.col("b").alias("component"))
    # The result of a class goes to its rows; a class of very many rows is dealt out by salt.
    told = classes.join(links, classes["rep"] == links["node"], "left") \
        .select(*sig, F.coalesce("component", "rep").alias("component"), "size", "rep") \
        .where("size > 1 OR component <> rep").select(*sig, "component", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = signed.select("id", *sig).withColumn("salt", F.pmod(F.hash("id"), F.lit(SALTS)))
    return dealt.join(told, [*sig, "salt"], "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNull(), F.col("id")).otherwise(F.coalesce("component", "id")).alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents whose component has a smaller id; columns unchanged, rows of a kept id stay together."""
    gone = jaccard_components(docs, k, num, den, id_col, text_col).where("component_id <> doc_id").select(F.col("doc_id").alias("_ngram_gone"))
    return docs.join(gone, F.col(f"`{id_col}`") == F.col("_ngram_gone"), "left_anti")
