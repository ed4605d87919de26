"""Rows that share an id: nothing of another row is lost."""
from collections import Counter

from surge.llm import exact, lines, ngram_join


def test_drop_exact_keeps_one_of_each_text(spark):
    rows = [(1, "Same text here.", "a"), (1, "Same text here.", "b"), (2, "other", "c"), (3, "Shared", "d"), (3, "only three has this", "e"),
            (4, "Shared", "f"), (None, "other", "g"), (None, "nobody else", "h"), (5, None, "i"), (5, "", "j"), (6, "ÄA", "k"), (6, "ÄA", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = exact.drop_exact(docs).collect()
    assert Counter((r["doc_id"], (r["text"] or "").lower()) for r in got) == Counter(
        [(1, "same text here."), (2, "other"), (3, "only three has this"), (4, "shared"), (None, "nobody else"), (5, ""), (6, "äa")])
    assert all(tuple(r) in rows for r in got) and docs.columns == got[0].__fields__
    assert exact.drop_exact(docs.limit(0)).count() == 0


def test_drop_lines_keeps_one_of_each_line(spark):
    long = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    other = "one two three four five six seven eight nine ten"
    rows = [(1, long), (1, long), (5, f"{other}\nfirst text of five has a line"), (5, f"{other}\nsecond text of five has another line"),
            (7, f"{long}\nseven alone says this"), (8, None), (8, ""), (9, "q w e r t y\nq w e r t y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lines.dedup_lines(docs)
    assert Counter(map(tuple, got.collect())) == Counter([
        (1, long), (1, ""), (5, f"{other}\nfirst text of five has a line"), (5, "second text of five has another line"),
        (7, "seven alone says this"), (8, None), (8, ""), (9, "q w e r t y")])
    # without hashes a line goes only where it is the same in all rows of the id
    plain = lines.drop_lines(docs, lines.repeated_lines(docs)).collect()
    assert Counter(map(tuple, plain)) == Counter(map(tuple, got.collect()))
    mixed = docs.unionAll(spark.createDataFrame([(7, "seven has another text whose first line is new\nx y z")], docs.schema))
    kept = {r["text"] for r in lines.drop_lines(mixed, lines.repeated_lines(mixed)).where("doc_id = 7").collect()}
    assert "seven has another text whose first line is new\nx y z" in kept
    assert "seven has another text whose first line is new\nx y z" in {r["text"] for r in lines.dedup_lines(mixed).where("doc_id = 7").collect()}


def test_templated_short_texts_stay_exact(spark):
    """Many short texts of one template: components equal brute force, whatever their number in a bundle."""
    import random
    rng = random.Random(4)
    words = "the quick report of station number was sent to the office on".split()
    rows = [(i, " ".join([*words, f"d{rng.randrange(6)}", f"e{rng.randrange(40)}"])) for i in range(900)]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(
        spark.createDataFrame(rows, "doc_id long, text string"), k=3, num=80, den=100).collect()}

    def shingles(t):
        w = t.split()
        return frozenset(tuple(w[i:i + 3]) for i in range(len(w) - 2))

    by = {}
    for i, t in rows:
        by.setdefault(shingles(t), []).append(i)
    sets, root = list(by), list(range(len(by)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for a, s in enumerate(sets):
        least[find(a)] = min(least.get(find(a), 10 ** 9), *by[s])
    assert got == {i: least[find(a)] for a, s in enumerate(sets) for i in by[s]}
