import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from surge.llm import lines, ngram_join


def test_lines_are_cut_in_the_task_as_a_split_cuts_them():
    texts = ["é a\nb", None, "", "\n", "one", "\n\nlast \n", "x\r\ny"]
    for column in (pa.array(texts, pa.string()), pa.array(["no\n", *texts, "no"], pa.string()).slice(1, len(texts))):
        got, row, line_no = lines.split_lines(column)
        want = [(i, j, x) for i, t in enumerate(texts) for j, x in enumerate((t or "").split("\n"))]
        assert [(i, j, x.removesuffix("\n")) for i, j, x in zip(row.tolist(), line_no.tolist(), got.to_pylist(), strict=True)] == want
    assert len(lines.split_lines(pa.array([], pa.string()))[0]) == 0


def groups(pairs):
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root if find(i) != i}


@pytest.mark.parametrize("held", [16, 1 << 20])
def test_prefixes_move_many_in_a_row_and_hold_the_same_lines_together(spark, monkeypatch, held):
    monkeypatch.setattr(lines, "HELD", held)
    monkeypatch.setattr(lines, "BUCKETS", 2)

    def sets(column):
        return ngram_join.shingle_sets(column, 5)

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        rng = np.random.default_rng(11)
        words = [f"w{i}" for i in range(60)]
        texts = ["\n".join(" ".join(words[a:a + n]) for a, n in zip(rng.integers(0, 12, 6), rng.integers(6, 45, 6), strict=True)) + "\n \n" for _ in range(40)]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
        cut = lines.line_table(docs, "doc_id", "text")
        ranks = ngram_join.rarity(cut, sets)
        both = lines.line_signatures(docs, sets, ranks, 80, 100).cache()
        plain = ngram_join.signatures(cut, sets, ranks, 80, 100, ["doc_id", "line_no"])
        cols = ["doc_id", "line_no", "n", "sig_a", "sig_b"]
        assert sorted(both.where("bucket IS NULL").select(cols).collect()) == sorted(plain.select(cols).collect())
        assert both.where("bucket IS NULL").agg(F.countDistinct("id")).first()[0] == 240
        packed = both.where("bucket IS NOT NULL").select("bucket", "postings")
        postings = plain.select(F.explode("prefix").alias("tok"), F.col("sig_a").alias("id"), "n")
        assert packed.agg(F.sum(F.length("postings"))).first()[0] == 16 * postings.count()
        if held > 16:
            assert packed.count() <= 2
        got = groups(lines.shared_tokens(packed, 80, 100).collect())
        assert got == groups(ngram_join.bundle_edges(postings, 80, 100).collect()) and got
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_line_hashes_go_along_with_their_lines(spark):
    line = "a b c d e f g"
    docs = spark.createDataFrame([(1, f"x\n{line}"), (2, f"{line.upper()}\n\n{line}"), (3, None), (None, line)], "doc_id long, text string")
    got = {tuple(r) for r in lines.repeated_lines(docs, with_hash=True).collect()}
    hashed = spark.createDataFrame([(line,), (line.upper(),)], "t string").select(F.xxhash64("t")).collect()
    assert got == {(2, 0, 1, 1, hashed[1][0]), (2, 2, 1, 1, hashed[0][0])}
