"""The corpus pipeline, stage by stage, against plain versions on a small table."""
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as pipe

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def shingles(text, k=5):
    w = words(text)
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def components(rows, num=80, den=100):
    """Smallest id reachable by links, from all pairs that share a shingle."""
    sets = {r["doc_id"]: shingles(r["text"]) for r in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            holders[x].add(i)
    for i, s in sets.items():
        for j, both in Counter(j for x in s for j in holders[x] if j < i).items():
            if den * both >= num * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def targets(sizes):
    """Weights 3, 1, 2 by source, 150 % of all sizes, none above twice its own: the excess is shared again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(order)}
    left, free, out = 1.5 * sum(sizes.values()), set(order), {}
    while True:
        over = [s for s in free if left * weight[s] / sum(weight[x] for x in free) > 2 * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        for s in over:
            out[s] = 2.0 * sizes[s]
            free.remove(s)
        left = 1.5 * sum(sizes.values()) - sum(out.values())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = [(900_001, "Это совсем другой язык, которого нет среди образцов, и он должен уйти целиком.", None, "web", 1),
            (900_002, "12345 67890 !!", None, "web", 1), (900_003, None, None, "web", 0), (900_004, "", None, None, 0)]
    docs = docs.unionAll(spark.createDataFrame(more, docs.schema))
    names = [n for n, _ in pipe.STAGES]
    assert names == ["language_id", "ngram_jaccard_join", "benchmark_decontamination", "source_mix", "token_output"]
    stage = dict(pipe.STAGES)

    known = stage["language_id"](spark, docs, SF).persist()
    kept = {r["doc_id"] for r in known.collect()}
    assert known.columns == docs.columns and not kept & {r[0] for r in more}
    told = [r for r in docs.collect() if r["lang"] and len(words(r["text"])) >= 5]
    assert sum(r["doc_id"] in kept for r in told) >= 0.97 * len(told)

    one = stage["ngram_jaccard_join"](spark, known, SF).persist()
    want = components(known.collect())
    assert {r["doc_id"] for r in one.collect()} == {i for i, c in want.items() if i == c} and one.columns == docs.columns

    clean = stage["benchmark_decontamination"](spark, one, SF).persist()
    kept = {r["doc_id"] for r in clean.collect()}
    items = [words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {s for w in items for s in shingles(" ".join(w))}
    for r in one.collect():
        said = " " + " ".join(words(r["text"])) + " "
        if any(len(w) >= 10 and " " + " ".join(w) + " " in said for w in items):
            assert r["doc_id"] not in kept
        elif not shingles(r["text"]) & held:
            assert r["doc_id"] in kept

    mixed = stage["source_mix"](spark, clean, SF).persist()
    copies = Counter(r["doc_id"] for r in mixed.collect())
    size = {r["doc_id"]: (r["source"], len(words(r["text"]))) for r in clean.collect()}
    by_source = Counter()
    for s, n in size.values():
        by_source[s] += n
    goal, most = targets(by_source), max(n for _, n in size.values())
    got = Counter()
    for i, c in copies.items():
        got[size[i][0]] += c * size[i][1]
    assert max(copies.values()) <= 2 and mixed.columns == docs.columns
    for s in by_source:
        assert abs(got[s] - goal[s]) <= most, (s, got[s], goal[s])

    told = stage["token_output"](spark, mixed, SF).collect()
    plain = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    expected = Counter()
    for r in mixed.collect():
        ids = [*plain.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        expected[r["doc_id"], len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in told) == expected
    at = 0
    for r in sorted(told, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]


def test_run_applies_the_stages(spark):
    docs = pipe.run(spark, SF)
    assert docs.count() > 0 and {"doc_id", "start", "n_tokens", "ids_crc32"} <= set(docs.columns)
