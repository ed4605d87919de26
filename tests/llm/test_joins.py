import random
import re

import numpy as np

from surge.llm import lines, ngram_join

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORDS.findall((text or "").translate(UPPER))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def similar(a, b, num, den):
    return bool(a) and bool(b) and den * len(a & b) >= num * len(a | b)


def variants(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def corpus():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [None, "", " \t\n", "one", "ONE", "one two", "é É", "A b c", "a B c"]
    for _ in range(6):
        texts += variants(rng, rng.choices(vocabulary, k=rng.choice([9, 12, 40, 80])), 15, 3)
    texts += variants(rng, rng.choices(vocabulary, k=3000), 3, 5)
    texts += [" ".join(rng.choices(vocabulary, k=30)) for _ in range(30)]
    texts += texts[20:40]
    rng.shuffle(texts)
    return list(enumerate(texts))


def components(rows, k, num, den):
    sets = {i: shingles(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and similar(sets[i], sets[j], num, den):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {(i, len(sets[i]), find(i)) for i in sets}


def test_components_equal_brute_force_also_with_small_tiles(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, n string, component_id int")
    for k, num, den, tile in [(3, 90, 100, 300_000), (3, 90, 100, 150), (5, 80, 100, 400)]:
        monkeypatch.setattr(ngram_join, "TILE", tile)
        got = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs, k, num, den).collect()}
        assert got == components(rows, k, num, den)


def test_one_document_of_each_group_stays(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i for i, _, c in components(rows, 5, 80, 100) if i == c}
    assert {r.doc_id for r in ngram_join.keep_one(docs).collect()} == want


def test_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (1, "a b c d"), (2, "A B c d"), (2, "A B c d")], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id) for r in ngram_join.jaccard_components(docs, 3, 90, 100).collect())
    assert got == [(False, 1, 1), (False, 2, 1), (False, 2, 1), (True, 0, None)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.jaccard_components(empty, 3, 90, 100).count() == 0
    assert lines.repeated_lines(empty).count() == 0


def earliest(rows, k, num, den):
    seen, out = [], set()
    for i, text in sorted(rows):
        for n, line in enumerate((text or "").split("\n")):
            s = shingles(line, k)
            if s:
                match = min(((d, m) for d, m, o in seen if similar(s, o, num, den)), default=None)
                if match:
                    out.add((i, n, *match))
                seen.append((i, n, s))
    return out


def test_lines_equal_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    parts = [t for _, t in corpus() if t and len(t) < 2000]
    rows = [(i, "\n".join(rng.choices(parts, k=rng.randrange(1, 6)) + [""] * rng.randrange(2))) for i in range(40)] + [(90, None), (91, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for tile in (300_000, 200):
        monkeypatch.setattr(lines, "TILE", tile)
        gone = lines.repeated_lines(docs)
        assert {tuple(r) for r in gone.collect()} == earliest(rows, 5, 80, 100)
    left = {r.doc_id: r.text for r in lines.drop_lines(docs, gone).collect()}
    lost = {(i, n) for i, n, _, _ in earliest(rows, 5, 80, 100)}
    for i, text in rows:
        assert left[i] == (text if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if (i, n) not in lost))


def test_rows_that_share_a_passage_are_told_apart_before_their_texts_move(spark, monkeypatch):
    """Whatever the rarity sketch tells: here it tells nothing, as with very many rows."""
    rng = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(i, passage + " " + " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(150))) for i in range(50)]
    docs += [(50, docs[3][1] + " end"), (51, "odd " + docs[4][1])]
    moved, keys = [], ngram_join.tile_keys
    monkeypatch.setattr(ngram_join, "rarity", lambda rows, sets: np.zeros(ngram_join.CELLS, np.uint8))
    monkeypatch.setattr(ngram_join, "tile_keys", lambda members, *rest: (moved.extend(r.id for r in members.select("id").collect()), keys(members, *rest))[1])
    out = ngram_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), k=5, num=80, den=100)
    got = {r.doc_id: r.component_id for r in out.collect()}
    assert got == {i: {50: 3, 51: 4}.get(i, i) for i in range(52)}
    assert set(moved) == {3, 4, 50, 51}


def test_parities_leave_every_similar_pair(spark):
    rng = random.Random(12)
    docs = []
    for i in range(40):
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(rng.choice([3, 20, 70, 64 * 5, 700]))]
        more = words[:]
        for _ in range(len(words) // 25):
            more[rng.randrange(len(more))] = "x"
        docs += [words, more + ["y"] * (len(words) // 30), words[:len(words) * 9 // 10], words * 2]
    rows = [(i, " ".join(w)) for i, w in enumerate(docs)]
    sets = [set(tuple(w[j:j + 3]) for j in range(max(len(w) - 2, 1))) for w in docs]
    close = {(i, j) for i in range(len(docs)) for j in range(i) if len(sets[i] & sets[j]) * 10 >= 3 * len(sets[i] | sets[j])}
    frame = spark.createDataFrame(rows, "id long, text string").coalesce(1)

    def shingles(column):
        return ngram_join.shingle_sets(column, 3)

    name = {r.id: r.sig_a for r in ngram_join.signatures(frame, shingles, None, 3, 10, ["id"]).collect()}
    pairs = spark.createDataFrame([(name[i], name[j]) for i in range(len(docs)) for j in range(i)], "a long, b long").distinct()
    bits = ngram_join.parities(frame, shingles).distinct()
    for num, den in ((3, 10), (8, 10)):
        kept = {(r.a, r.b) for r in ngram_join.near_pairs(pairs, bits, num, den).collect()}
        assert {(name[i], name[j]) for i, j in close if len(sets[i] & sets[j]) * den >= num * len(sets[i] | sets[j])} <= kept
    alike = {(name[i], name[j]) for i in range(len(docs)) for j in range(i) if 0.8 <= len(sets[i]) / len(sets[j]) <= 1.25}
    assert len(kept & alike) < len(alike) / 5  # pairs of other sizes never get here
