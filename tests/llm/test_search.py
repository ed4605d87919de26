import glob
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from surge.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, top):
    counted = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n, total = sum(1 for c in counted if c[2]), sum(c[2] for c in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, words in asked.items():
        found = []
        for i, c, size in counted:
            m = 100 - 50 + ((50 * size * n) // total if total else 0)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m)) for t in words if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r, None if bare else i, -s) for r, (s, bare, i) in enumerate(sorted(found)[:top], 1)]
    return out


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(250)] + ["Été", "straße", "日本", "x9", "A"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 3, 10, 40, 120])))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, " .,- "), (None, docs[5][1]), (7, docs[8][1]), docs[9], docs[9], (n + 3, "w1,W1;w1-w2_w2 \U0001f600x"),
             (n + 4, " ".join(rng.choices(vocabulary, k=30_000)))]
    items = [(j, " ".join(rng.choices(vocabulary, k=rng.choice([1, 4, 30, 120])))) for j in range(25)]
    items += [(40, None), (41, ""), (42, "nowhere"), (None, "w3 w4"), (3, "w200 w201"), (43, "W1 w1. été")]
    return docs, items


def tables(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))


def key(row):
    return tuple((x is None, x or 0) for x in row)


def test_equals_brute_force(spark, monkeypatch):
    for seed, top, block in ((1, 50, 1 << 20), (2, 3, 300)):
        docs, items = corpus(seed)
        d, q = tables(spark, docs, items)
        monkeypatch.setattr(search, "STEP", 16)
        found = search.search(search.build_index(d.repartition(3)), q, top=top, block_bytes=block)
        got = sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found.collect()), key=key)
        assert got == sorted(brute(docs, items, top), key=key)


def test_small_segments(spark):
    """Cut into many segments the index ranks alike."""
    docs, items = corpus(3, 120)
    d, q = tables(spark, docs, items)
    index = search.build_index(d.repartition(40))
    assert index.count() >= 30
    got = sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in search.search(index, q, top=5).collect()), key=key)
    assert got == sorted(brute(docs, items, 5), key=key)


def test_masks_group_documents_and_stop_early():
    rng = np.random.default_rng(4)
    held = rng.random((70, 500)) < 0.1
    group, present = search.presence_masks([np.packbits(x) for x in held], 500)
    assert (present[:, group] == held).all() and len(np.unique(present, axis=1).T) == present.shape[1]


def test_few_documents_are_scored(spark):
    """Groups whose bound is below the last of the best are never scored."""
    docs = [(i, "common filler") for i in range(5000)] + [(9000 + i, "common rare gem") for i in range(60)]
    index = search.build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    batch = index.toArrow().to_batches()[0]
    import pyarrow as pa
    segment = search.Segment(batch, 0, pa.array(["common", "gem", "rare"]), 5060, 10180)
    best = search.Best(50)
    assert segment.search(np.array([0, 1, 2]), np.array([1, 4000, 4000]), best) == 60 and len(best.score) == 50


def test_empty_and_clashing_names(spark):
    d, q = tables(spark, [], [])
    full_d, full_q = tables(spark, *corpus(5, 30))
    for docs, items in ((d, full_q), (full_d, q), (d, q)):
        got = search.search(search.build_index(docs), items)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0
    clash = full_d.selectExpr("*", "1 AS id", "'x' AS terms", "2 AS ids")
    assert search.search(search.build_index(clash), full_q.selectExpr("*", "1 AS item", "'y' AS term")).count() > 0


def test_a_reader_holds_one_segment_at_a_time(spark, monkeypatch):
    """However many segments a task writes to a file, each is a row group and a batch of its own."""
    monkeypatch.setattr(search, "GROUP_BYTES", 1)
    docs = [(i, f"w{i % 7} w{i % 11}") for i in range(25_000)]  # batches of 10,000 rows at most: three segments in a file
    d, q = tables(spark, docs, [(1, "w3 w8")])
    index = search.build_index(d.coalesce(1))
    files = [pq.ParquetFile(f).metadata for f in glob.glob(index._staged_path.removeprefix("file:") + "/*.parquet")]
    assert sum(m.num_rows for m in files) > 2 and all(m.num_row_groups == m.num_rows for m in files)
    batches, rank = [], search._rank

    def sizes(rows):
        for batch in rows:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    monkeypatch.setattr(search, "_rank", lambda index, *rest: (batches.extend(r.n for r in index.mapInArrow(sizes, "n long").collect()), rank(index, *rest))[1])
    got = sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in search.search(index, q, 5).collect()), key=key)
    assert got == sorted(brute(docs, [(1, "w3 w8")], 5), key=key)
    assert len(batches) > 2 and set(batches) == {1}
    assert spark.conf.get(search.BATCH_ROWS) == "10000"
