import numpy as np
from pyspark.sql import functions as F

from surge.llm import batches, lines, ngram_join


def test_distinct_pairs_and_rare_first_equal_a_plain_sort():
    rng = np.random.default_rng(5)
    upper = rng.integers(0, 2**63, 40, dtype=np.uint64) << np.uint64(1)
    cases = [(rng.integers(0, d, n), v) for d, n, v in (
        (900, 30_000, rng.integers(0, 2**64, 30_000, dtype=np.uint64)), (1, 500, rng.integers(0, 50, 500, dtype=np.uint64)),
        (7, 3000, upper[rng.integers(0, 40, 3000)] + rng.integers(0, 4, 3000, dtype=np.uint64)),  # lower bits tell them apart
        (1 << 30, 64, rng.integers(0, 2**64, 64, dtype=np.uint64)), (3, 0, np.zeros(0, np.uint64)))]
    ranks = rng.integers(0, 256, ngram_join.CELLS).astype(np.uint8)
    for doc, value in cases:
        doc, code = batches.distinct_sorted(doc.astype(np.int64), value)
        assert list(zip(doc.tolist(), code.tolist(), strict=True)) == sorted(set(zip(doc.tolist(), code.tolist(), strict=True)))
        order = ngram_join.rare_first(doc, code, ranks)
        assert (order == np.lexsort((code, ranks[ngram_join.cells_of(code)], doc))).all()


def test_a_task_sends_the_prefix_of_equal_lines_once(spark):
    line = " ".join(f"w{i}" for i in range(54))  # 50 shingles
    docs = spark.createDataFrame([(i, line) for i in range(40)] + [(90, line + " x1 x2")], "doc_id long, text string").coalesce(1)

    def sets(column):
        return ngram_join.shingle_sets(column, 5)

    ranks = ngram_join.rarity(docs, sets)
    signed = ngram_join.signatures(docs, sets, ranks, 80, 100, ["doc_id"])
    assert signed.where("n = 50").agg(F.sum(F.size("prefix"))).first()[0] == 11
    assert {tuple(r) for r in lines.repeated_lines(docs).collect()} == {(i, 0, 0, 0) for i in [*range(1, 40), 90]}


def test_lines_that_match_nothing_do_not_move_and_every_wanted_one_stays(spark, monkeypatch):
    texts = spark.range(20_000).selectExpr("id AS doc_id", "CAST(id % 7 AS int) AS line_no", "concat('t', id) AS text")
    keys = texts.where("doc_id % 100 = 3").selectExpr("doc_id", "CAST(line_no AS long) AS line_no")
    few = ngram_join.sketched(texts, keys, ["doc_id", "line_no"])
    assert few.columns == texts.columns and few.count() < 400
    assert few.join(keys, ["doc_id", "line_no"]).count() == 200
    assert ngram_join.sketched(texts, keys.limit(0), ["doc_id", "line_no"]).count() == 0
    monkeypatch.setattr(ngram_join, "KEY_BITS", 13)  # a full bitmap keeps more, never less
    assert ngram_join.sketched(texts, keys, ["doc_id", "line_no"]).join(keys, ["doc_id", "line_no"]).count() == 200


def test_pairs_of_several_tiles_and_sides_equal_brute_force(monkeypatch):
    rng = np.random.default_rng(3)
    for run in (1, 9, 1 << 18):
        monkeypatch.setattr(lines, "PAIRS", run)
        for _ in range(10):
            tile = np.sort(rng.integers(0, 4, 30))
            both = rng.integers(0, 2, 4) == 0
            side = np.where(both[tile], 2, rng.integers(0, 2, 30))
            sets = [np.unique(np.concatenate([np.arange(rng.integers(1, 25)), rng.integers(30, 90, rng.integers(0, 3))])).astype(np.uint64) for _ in tile]
            size = np.array([len(s) for s in sets])
            u, v = lines.matches(np.concatenate(sets), size, tile, side, 80, 100)
            want = set()
            for i in range(30):
                for j in range(30):
                    common = len(np.intersect1d(sets[i], sets[j]))
                    meet = tile[i] == tile[j] and ((side[i] == 2 and i < j) or (side[i] == 0 and side[j] == 1))
                    if meet and 100 * common >= 80 * (size[i] + size[j] - common):
                        want.add((i, j))
            assert sorted(zip(u.tolist(), v.tolist(), strict=True)) == sorted(want)


def test_classes_of_many_lines_are_told_as_small_ones_are(spark, monkeypatch):
    line = " ".join(f"w{i}" for i in range(54))
    docs = spark.createDataFrame([(i, f"{line}\n \t\x0b\nonly {i}") for i in range(12)] + [(90, line + " x1 x2\n" + line + " x1 x2")], "doc_id long, text string")
    want = {(i, 0, 0, 0) for i in range(1, 12)} | {(90, 0, 0, 0), (90, 1, 0, 0)}
    for many in (1, 5, 1024):
        monkeypatch.setattr(lines, "MANY", many)
        assert {tuple(r) for r in lines.repeated_lines(docs).collect()} == want
