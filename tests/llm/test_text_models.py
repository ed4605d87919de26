import random
import re

import numpy as np
import pyarrow as pa

from surge.llm import decontaminate, language, substring, toxicity

SYLLABLES = {"aa": ["ba", "lo", "mi", "ren", "tu"], "bb": ["sch", "ung", "keit", "ber", "ze"], "cc": ["eau", "tion", "oi", "que", "vé"]}


def words(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(n))


def test_language_held_out_and_edges(spark):
    rng = random.Random(1)
    rows = [(i, words(rng, lang := rng.choice([*SYLLABLES]), rng.randrange(5, 80)), lang) for i in range(600)]
    train = spark.createDataFrame([*rows[:400], (9000, None, "aa"), (9001, "x", None)], "doc_id long, text string, lang string")
    model = language.fit(train, "text", "lang", "doc_id")
    test = spark.createDataFrame([*[(i, t, "hidden", 1.0) for i, t, _ in rows[400:]], (1, None, "a", 1.0), (2, "", "a", 1.0), (3, "12 - 9!", "a", 1.0)],
                                 "doc_id long, text string, lang string, lang_score double")
    got = {r.doc_id: r for r in language.identify(test, model).collect()}
    truth = {i: lang for i, _, lang in rows[400:]}
    assert np.mean([got[i].lang_pred == truth[i] for i in truth]) > 0.97
    assert not any(got[i].rejected for i in truth)
    for i in (1, 2, 3):
        assert (got[i].lang_pred, got[i].lang_score, got[i].rejected, got[i].lang) == ("und", 0.0, True, "a")
    assert all(0 <= r.lang_score <= 1 for r in got.values())
    nothing = language.fit(train.limit(0), "text", "lang", "doc_id")
    assert {r.lang_pred for r in language.identify(test, nothing).collect()} == {"und"}
    assert language.identify(test.limit(0), model).count() == 0


def test_language_rejects_what_it_did_not_learn(spark):
    rng = random.Random(11)
    rows = [(i, words(rng, lang := rng.choice([*SYLLABLES]), rng.randrange(40, 300)), lang) for i in range(600)]
    model = language.fit(spark.createDataFrame([*rows, (9000, "only one of it", "dd")], "doc_id long, text string, lang string"), "text", "lang", "doc_id")
    assert (model.floor[3] == model.floor[:3].min(axis=0)).all() and model.floor[3].any()
    alien = {"script": "Все люди рождаются свободными и равными в своем достоинстве и правах. ", "greek": "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι. ",
             "han": "人人生而自由,在尊严和权利上一律平等。", "latin": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. ",
             "finnish": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. ",
             "random": " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=rng.randrange(3, 12))) for _ in range(60)),
             "consonants": " ".join("".join(rng.choices("bcdfghjklmnpqrstvwxz", k=rng.randrange(3, 9))) for _ in range(60))}
    docs = [(i, v * times) for i, (v, times) in enumerate((v, t) for v in alien.values() for t in (2, 20))]
    own = [(1000 + i, words(rng, [*SYLLABLES][i % 3], n)) for i, n in enumerate([2, 4, 8, 16, 60, 400] * 15)]
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(docs + own, "doc_id long, text string"), model).collect()}
    assert [i for i, _ in docs if not got[i].rejected] == []
    assert [t for i, t in own if got[i].rejected] == []


def restorer(rng):
    text = " ".join(["the old clown idiot is stupid and worthless", "moron loser trash scum disgusting pathetic"] * 50 + [words(rng, "aa", 300)])
    texts = language.Texts(pa.array([text], pa.large_string()))
    s = toxicity._SYMBOL[texts.data]
    counts = np.bincount((s[:-2] * toxicity.SYMBOLS + s[1:-1]) * toxicity.SYMBOLS + s[2:], minlength=toxicity.SYMBOLS ** 3)
    return toxicity.Restorer(toxicity.log_probabilities(counts.reshape((toxicity.SYMBOLS,) * 3).astype(float)))


def test_restoring():
    r = restorer(random.Random(2))
    for said, meant in [("l0ser", "loser"), ("s c u m", "scum"), ("m.o.r.o.n", "moron"), ("tr@sh", "trash"), ("$tupid", "stupid"),
                        ("1d10t", "idiot"), ("d1sgu5t1ng", "disgusting"), ("cl-o-wn", "clown"), ("mooooron", "moron")]:
        assert toxicity.evidence(pa.array([f"It is {said} there"]), r).restored == [meant], said
    plain = toxicity.evidence(pa.array(["A plain text, with signs. And 3 numbers: 42!", None, ""]), r)
    assert plain.restored == ["", "", ""]
    assert r.restore("x1" * 500)  # long tokens are decoded in stretches


def test_restoring_at_the_ends_doubled_and_spaced_words():
    r = restorer(random.Random(2))
    for said, meant in [("idio+", "idiot"), ("mor0n5", "moron"), ("worthle55", "worthless"), ("worthle$$", "worthless"), ("$$tupid", "stupid"),
                        ("10ser", "loser"), ("!diot", "idiot"), ("iiddiioott", "idiot"), ("idiiot", "idiot"), ("tra$$h", "trash"),
                        ("o l d s c u m", "old scum"), ("i d i o t s c u m", "idiot scum"), ("y o u i d i o t", "you idiot"), ("l o s e r r", "loser")]:
        assert toxicity.evidence(pa.array([f"It is {said} there"]), r).restored == [meant], said
    assert toxicity.evidence(pa.array(["It is stupid! there, now, in 1995."]), r).restored == [""]


def test_toxicity_held_out(spark):
    rng = random.Random(3)
    bad, hidden = ["idiot", "moron", "scum", "loser"], ["1diot", "m0ron", "s.c.u.m", "l o s e r"]
    rows = []
    for i in range(900):
        t = words(rng, rng.choice([*SYLLABLES]), rng.randrange(10, 60)).split()
        label = int(i % 6 == 0)
        for _ in range(3 * label):
            t.insert(rng.randrange(len(t)), rng.choice(bad if i < 600 else bad + hidden))
        rows.append((i, " ".join(t), label))
    df = spark.createDataFrame([*rows, (9000, None, 0), (9001, "", None)], "doc_id long, text string, toxic int")
    model = toxicity.fit(df, df.where("doc_id < 600"))
    got = {r.doc_id: r.toxicity for r in toxicity.score(df.withColumnRenamed("toxic", "restored"), model).collect()}
    right = [(got[i] >= 0.5) == bool(label) for i, _, label in rows[600:]]
    assert np.mean(right) > 0.97
    assert got[9000] < 0.5 and got[9001] < 0.5 and len(got) == 902
    blank = toxicity.fit(df.limit(0), df.limit(0))
    assert toxicity.score(df, blank).where("toxicity between 0 and 1").count() == 902


def test_wand_returns_what_full_scoring_does():
    rng = random.Random(4)
    items = [(i, words(rng, rng.choice([*SYLLABLES]), rng.randrange(5, 60))) for i in range(150)]
    code, first = decontaminate._word_hashes([t for _, t in items])
    df = {}
    for a, b in zip(first[:-1], first[1:]):
        for c in set(code[a:b].view(np.int64).tolist()):
            df[c] = df.get(c, 0) + 1
    index = decontaminate.build_index(items, df, 150, 30.0, 64, 5)
    for seed in range(60):
        terms = np.unique(np.random.default_rng(seed).integers(0, len(index.terms), 25))
        score = np.zeros(150)
        for t in terms:
            score[index.item[index.begin[t]:index.begin[t + 1]]] += index.weight[index.begin[t]:index.begin[t + 1]]
        for threshold in (0.02, 0.1, 0.3):
            assert {i for i, _ in index.search(terms, threshold)} == set(np.flatnonzero(score >= threshold - 1e-9).tolist())


def test_decontamination_finds_planted_items_only(spark):
    rng = random.Random(5)
    long = " ".join(f"long{i}" for i in range(400))
    items = [(i, words(rng, "aa", 30) + "? " + words(rng, "bb", rng.randrange(1, 9)) + ".") for i in range(40)] + [(90, None), (91, ""), (92, "?!"), (93, long)]
    docs, want = [], set()
    for i in range(200):
        t = words(rng, rng.choice([*SYLLABLES]), rng.randrange(20, 400)).split()
        if i % 5 == 0:
            k = rng.randrange(40)
            t.insert(rng.randrange(len(t)), re.sub(r"\s+", " ", items[k][1].upper()) if i % 2 else items[k][1])
            want.add((i, k))
        docs.append((i, " ".join(t)))
    docs += [(500, "before " + long + " after"), (501, None), (502, "")]
    want.add((500, 93))
    df = spark.createDataFrame([(i, t, "s") for i, t in docs], "doc_id long, text string, score string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench).collect()} == want
    left = decontaminate.decontaminate(df, bench)
    assert left.columns == df.columns
    assert {r.doc_id for r in left.collect()} == {i for i, _ in docs} - {i for i, _ in want}
    assert decontaminate.contaminated(df.limit(0), bench).count() == 0
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0


def test_chunk_borders_move_with_the_text():
    rng = random.Random(6)
    text = words(rng, "cc", 2000)
    a = language.Texts(pa.array([text], pa.large_string()), lower=False)
    b = language.Texts(pa.array(["inserted é " + text], pa.large_string()), lower=False)
    shift = len("inserted é ".encode())
    one, two = (set(substring.borders(x.data, x.offs).tolist()) for x in (a, b))
    late = {x for x in one if x > 64}
    assert {x + shift for x in late} <= two
    assert len(a.data) / len(one) < 60
    for x in one:
        a.data[:x].tobytes().decode()


def test_repeated_passages(spark):
    rng = random.Random(7)
    passage = words(rng, "bb", 60)
    docs = [(i, words(rng, "cc", 80) + " " + words(rng, "aa", 120)) for i in range(60)]
    marked = {3, 17, 42}
    docs = [(i, t.replace(" ", " " + passage + " ", 1) if i in marked else t) for i, t in docs] + [(100, None), (101, ""), (None, passage), (102, "q " * 4000)]
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, start int")
    spans = substring.repeated_spans(df)
    got = spans.collect()
    assert {(r.doc_id, r.first_doc_id) for r in got} == {(17, 3), (42, 3)}
    texts = dict(docs)
    for r in got:
        assert texts[r.doc_id].encode()[r.start:r.end].decode() in passage
    cut = {r.doc_id: r.text for r in substring.remove_spans(df, spans).collect()}
    assert cut[3] == texts[3] and len(cut[17]) < len(texts[17]) and cut[100] is None
    assert {r.doc_id for r in substring.repeated_spans(df, within_document=True).collect()} == {17, 42, 102}
    assert substring.repeated_spans(df.limit(0)).count() == 0


def test_every_passage_of_just_over_fifty_short_words_is_found(spark):
    rng = random.Random(12)
    docs, want = [], {}

    def short(n):
        return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyzé", k=rng.randrange(2, 6))) for _ in range(n))

    for i in range(300):
        passage = short(51 + i % 10)
        for j in (i, 1000 + i):
            docs.append((j, f"{short(rng.randrange(1, 60))} <{passage}> {short(rng.randrange(1, 60))}"))
        want[1000 + i] = passage
    docs += [(5000, "the last words of a text " + want[1007]), (5001, want[1008] + " the first")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {}
    for r in substring.repeated_spans(df).collect():
        assert r.doc_id not in got
        got[r.doc_id] = r
    assert got.keys() == want.keys() | {5000, 5001}
    texts = dict(docs)
    for i, passage in want.items():
        cut = texts[i].encode()[got[i].start:got[i].end].decode()
        assert got[i].first_doc_id == i - 1000
        assert f"<{passage}>" == cut or " ".join(passage.split()[1:-1]) in cut
    for i in (5000, 5001):
        assert len(texts[i].encode()[got[i].start:got[i].end].decode().split()) >= 50
