import hashlib
import random

import numpy as np
import pytest

from surge.llm import suffixes

LENGTH = 64


def brute(texts, length):
    seen = {}
    raw = [(t or "").encode() for t in texts]
    for i, b in enumerate(raw):
        for p in range(len(b) - length + 1):
            seen.setdefault(b[p:p + length], []).append((i, p))
    gone = [np.zeros(len(b), dtype=bool) for b in raw]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                gone[i][p:p + length] = True
    out = []
    for b, g in zip(raw, gone):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], g.astype(np.int8), [0]])))
        kept = bytes(np.frombuffer(b, dtype=np.uint8)[~g])
        out.append((len(b), [(int(x), int(y)) for x, y in zip(edge[::2], edge[1::2])], kept))
    return out


def corpus(seed):
    rng = random.Random(seed)

    def noise(n, letters="abcdefghij klmnop"):
        return "".join(rng.choices(letters, k=n))

    shared = [noise(n) for n in (63, 64, 65, 80, 100, 130, 200, 400)] + ["äöü€\U0001f600 " * 12]
    texts = [None, "", "x", "a" * 63, "b" * 64, "c" * 65, "d" * 300, "e" * 300 + "f", "ab" * 100, "xyz" * 50 + noise(30)]
    for s in shared:
        for _ in range(rng.choice([2, 3, 6])):
            texts.append(noise(rng.randrange(150)) + s + noise(rng.randrange(150)))
    base = noise(500)
    texts += [base] * 5 + [base[1:], base[:-1], base + "!", "?" + base, base[:250] + "#" + base[250:], base[:100] + base[160:]]
    for _ in range(40):  # one passage with many surroundings, some of them alike
        texts.append(noise(rng.randrange(30), "ab") + shared[4] + noise(rng.randrange(30), "ab"))
    texts += [noise(rng.randrange(300)) for _ in range(10)]
    texts.append(shared[5] + noise(90) + shared[5] + noise(10) + shared[5])  # within one text
    texts += ["".join(rng.choices("ab", k=400)) for _ in range(3)] + ["ab" * 20 + noise(20) + "ab" * 60]
    rng.shuffle(texts)
    return texts


def check(spark, texts, length=LENGTH, parts=3):
    rows = [(i // 2, t) for i, t in enumerate(texts)]  # repeated ids
    rows += [(None, texts[3]), (None, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = suffixes.suffix_dedup(docs, length).collect()
    want = brute([t for _, t in rows], length)
    key = lambda r: (r[0] is None, r[0] or 0, r[3], r[2])
    assert sorted(((r["doc_id"], r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in got), key=key) == \
        sorted(((i, n, spans, kept) for (i, _), (n, spans, kept) in zip(rows, want)), key=key)
    assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in got)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    check(spark, corpus(seed))


@pytest.mark.parametrize("limit", [2, 9])
def test_large_groups_are_split(spark, monkeypatch, limit):
    monkeypatch.setattr(suffixes, "LIMIT", limit)
    check(spark, corpus(3 + limit))


def test_production_length(spark):
    rng = random.Random(8)
    base = ["".join(rng.choices("abcdefgh ", k=n)) for n in (399, 400, 401, 700, 3000)]
    texts = ["".join(rng.choices("xyz ", k=rng.randrange(300))) + b + "".join(rng.choices("uvw ", k=rng.randrange(300))) for b in base for _ in range(3)]
    check(spark, texts + [base[4], base[4], base[4][:1500] + "-" + base[4][1500:]], 400)


def test_long_text_is_cut(monkeypatch):
    """Cut into parts a text has the same strings under the same anchors."""
    rng = np.random.default_rng(3)
    data = rng.integers(97, 101, size=5000).astype(np.uint8)
    whole = suffixes.anchors(data, np.array([0, 5000]), LENGTH)

    def strings(at, first, last, plus=0):
        return {(p + plus, a + plus) for a, x, y in zip(at.tolist(), first.tolist(), last.tolist()) for p in range(x, y + 1)}

    monkeypatch.setattr(suffixes, "SLICE_BYTES", 700)
    import pyarrow as pa
    cut = set()
    for part, offs, _, place in suffixes._pieces(pa.array([bytes(data).decode()]), LENGTH):
        cut |= strings(*suffixes.anchors(part, offs, LENGTH), plus=int(place[0]))
    assert cut == strings(*whole) and {p for p, _ in cut} == set(range(5000 - LENGTH + 1))


def test_deep_shallow_sorts():
    rng = random.Random(5)
    heads = ["".join(rng.choices("ab", k=90)).encode() for _ in range(4)] + [b"", b"a\0b"]
    strings, group = [], []
    for g in range(30):
        for _ in range(rng.choice([1, 2, 7, 40])):
            strings.append(rng.choice(heads) + bytes(rng.choices([0, 97, 98], k=rng.randrange(12))))
            group.append(g)
    size = np.array([len(s) for s in strings])
    rows = np.zeros((len(strings), size.max()), dtype=np.uint8)
    for i, s in enumerate(strings):
        rows[i, :len(s)] = np.frombuffer(s, dtype=np.uint8)
    order, shared = suffixes.deep_shallow(rows, size, np.array(group))
    assert [(group[i], strings[i]) for i in order] == sorted(zip(group, strings))
    for k in range(1, len(order)):
        s, t = strings[order[k - 1]], strings[order[k]]
        n = next((j for j, (x, y) in enumerate(zip(s, t)) if x != y), min(len(s), len(t)))
        assert shared[k] == (n if group[order[k - 1]] == group[order[k]] else 0)


def test_blind_trie():
    rng = random.Random(6)
    for _ in range(200):
        strings = [bytes(rng.choices([0, 1, 2], k=rng.randrange(9))) for _ in range(rng.randrange(30))]
        assert [strings[i] for i in suffixes.blind_order(strings)] == sorted(strings)


def test_empty_and_clashing_names(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.suffix_dedup(docs).columns == ["doc_id", "n_bytes", "spans", "kept_sha256", "kept"]
    assert suffixes.suffix_dedup(docs).count() == 0
    clash = spark.createDataFrame([(1, "q" * 500, 2, "x")], "doc_id long, text string, id int, core string")
    row = suffixes.suffix_dedup(clash, with_text=False).collect()[0]
    assert (row["doc_id"], row["n_bytes"], [tuple(s) for s in row["spans"]], row["kept"]) == (1, 500, [(0, 500)], None)
