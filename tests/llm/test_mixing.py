import re
from collections import defaultdict

import pytest

from surge.llm import mixing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def water_fill(sizes, weights, budget, most):
    """Targets by sharing, capping and sharing the excess again until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = budget * sum(sizes.values())
    capped = set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        share = sum(w[s] for s in names if s not in capped)
        target = {s: most * sizes[s] if s in capped else left * w[s] / share for s in names}
        over = {s for s in names if s not in capped and target[s] > most * sizes[s]}
        if not over:
            return target
        capped |= over
        if len(capped) == len(names):
            return {s: most * sizes[s] for s in names}


def test_targets_and_taken_words(spark):
    rows = [(i, "w " * (1 + i * 7 % 50), "abcdefg"[i % 7] if i % 3 else "a") for i in range(3000)]
    rows += [(9000, None, None), (9001, "", None), (9002, "one two", None), (None, "x y z", "b"), (5, "twice", "c"), (5, "twice", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(WORDS.findall(text or ""))
    want = water_fill(sizes, (3, 1, 2), 1.5, 2.0)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for s in sizes:
        assert taken[s] <= want[s] + 1e-6
        assert want[s] - taken[s] <= 50
    again = {(r.doc_id, r.taken) for r in mixing.mix(docs).collect()}
    assert again == {(r.doc_id, r.taken) for r in got}


def test_thresholds_are_nested(spark):
    docs = spark.createDataFrame([(i, "a b c d", "xy"[i % 2]) for i in range(400)], "doc_id long, text string, source string")
    small, large = ({r.doc_id: r.taken for r in mixing.mix(docs, budget=b, weights=(1,), most=1.0).collect()} for b in (0.3, 0.6))
    assert all(large[i] >= small[i] for i in small)
    assert 0 < sum(small.values()) < sum(large.values())


def test_apply_repeats_rows_and_keeps_clashing_columns(spark):
    docs = spark.createDataFrame([(i, "a b c", "s", f"h{i}", 7) for i in range(50)], "doc_id long, text string, source string, hash string, below int")
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns
    assert out.count() == 75
    assert out.distinct().count() == 50


def test_empty_and_wordless(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(empty).count() == 0
    assert mixing.apply_mix(empty).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", "a")], "doc_id long, text string, source string")
    assert [r.taken for r in mixing.mix(blank).collect()] == [0, 0]
