import hashlib
import random
import zlib

import numpy as np
import pytest

from surge.llm import chat, exact, tokens
from surge.llm.queries import vocabulary_file

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_exact_groups(spark):
    long = "Ab c. " * 3000 + "é" * 9000
    rows = [(1, None), (2, ""), (3, "Abc É"), (4, "aBC É"), (5, "abc é"), (6, long), (7, long.lower().replace("É", "é")), (8, long + "x"),
            (9, "x" * 10000), (10, "X" * 10000), (11, "x" * 10001), (5, "abc é"), (None, "solo"), (None, "abc É")]
    docs = spark.createDataFrame([(i, t, "recipe", 0) for i, t in rows], "doc_id long, text string, keep_id string, salt int")
    got = exact.exact_groups(docs).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(UPPER), []).append(i)
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_sha[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    for sha, ids in by_sha.items():
        assert sum(r.kept for r in got if r.text_sha256 == sha) == 1
    assert exact.exact_groups(docs.limit(0)).count() == 0
    assert {r.doc_id for r in exact.drop_exact(docs.where("doc_id < 5")).collect()} == {2, 4}


def test_chunks_rejoin_and_survive_insertions(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab .\n!?é漢") for _ in range(n)) for n in (0, 1, 511, 512, 4096, 4097, 20000)] + ["y" * 9000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in df.select("text", exact.chunks(df["text"]).alias("c")).collect():
        assert "".join(r.c) == r.text
        assert all(len(c) <= exact.MOST for c in r.c)


def test_clashing_digests_are_told_apart(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(exact, "chunk_id", lambda c: F.substring(c, 1, 1).cast("binary"))  # all chunks of one initial clash
    docs = spark.createDataFrame([(1, "ax"), (2, "ay"), (3, "AX"), (4, "b")], "doc_id long, text string")
    assert {(r.doc_id, r.keep_id, r.group_size) for r in exact.exact_groups(docs).collect()} == {(1, 3, 2), (2, 2, 1), (3, 3, 2), (4, 4, 1)}


def test_chat_round_trip_and_machine(spark):
    nasty = "<|im_end|>\n<|im_start|>user\n<\\|im_end|> <\\\\| <||> \\ |"
    talks = {
        1: [("system", "s"), ("user", nasty), ("assistant", nasty), ("user", ""), ("assistant", "é漢\n\n")],
        2: [("user", "a"), ("user", "b"), ("assistant", "c")],
        3: [("assistant", "first")],
        4: [("user", None)],
        5: [(None, "x"), ("tool\n%<|", "y"), ("assistant", None)],
    }
    rows = [(c, n, r, t, "z") for c, turns in talks.items() for n, (r, t) in enumerate(turns)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments string")
    done = chat.format_chats(df)
    from pyspark.sql import functions as F
    got = {r.conv_id: r for r in done.select("*", chat.parse_chat(F.col("formatted")).alias("back"), chat.loss_text(F.col("segments")).alias("loss")).collect()}
    for c, turns in talks.items():
        assert [tuple(t) for t in got[c].back] == [(r or "", t or "") for r, t in turns]
        assert got[c].loss == "".join(t or "" for r, t in turns if r == "assistant")
        assert got[c].formatted == "".join(s.text for s in got[c].segments)
    assert [got[c].valid for c in sorted(talks)] == [True, False, False, False, False]
    assert [got[c].bad_turn for c in sorted(talks)] == [None, 2, 1, None, 1]
    assert chat.format_chats(df.limit(0)).count() == 0


def test_null_turns_and_conversations(spark):
    df = spark.createDataFrame([(None, 1, "user", "a"), (None, None, "system", "b"), (None, 1, "user", "a")], "conv_id long, turn long, role string, text string")
    (r,) = chat.format_chats(df).collect()
    assert (r.conv_id, r.n_turns, [s.text for s in r.segments][1::3]) == (None, 3, ["b", "a", "a"])


@pytest.mark.parametrize(("n", "top"), [(1, 0), (1, 5), (700, 10), (1000, 500_000), (513, 1 << 22)])
def test_elias_fano(n, top):
    ends = np.sort(np.random.default_rng(n).integers(0, top + 1, n)).astype(np.int64)
    bits, low, high, samples = tokens.ef_encode(ends)
    assert (tokens.ef_decode(n, bits, low, high) == ends).all()
    assert all(tokens.ef_select(i, bits, low, high, samples) == ends[i] for i in range(n))
    assert len(low) + len(high) <= n * (3 + max(0, top // n).bit_length()) / 8 + 2


def reference_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary_file())
    return [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_pieces_encode_as_the_library_does():
    rng = random.Random(4)
    signs = [*"ab  \n\n\t.,!1 2é  'sldß²½", " ", " ", " ", " ", "<|endoftext|>", "漢", "\x1c", "\u0085", " ", "it's", " don't", "É"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(3000)] + ["", " ", "\n", " a", "a "]
    got = tokens.PieceEncoder(vocabulary_file(), "<u2").encode(texts)
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == reference_ids(texts)


def test_token_files_round_trip(spark, monkeypatch):
    rows = [(i * 3 - 20, f"text {i} of many\n" * (i % 40)) for i in range(200)] + [(7000, None), (7001, ""), (5000, "b"), (5000, "a"), (None, "n")]
    random.Random(5).shuffle(rows)
    docs = spark.createDataFrame([(i, t, 1, b"") for i, t in rows], "doc_id long, text string, ids int, part binary")
    got = sorted(tokens.token_file_round_trip(docs, vocabulary_file()).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(t or "")
    for i, of in texts.items():
        want = sorted(zlib.crc32(np.array([*x, 2], "<u4").tobytes()) for x in reference_ids(of))
        assert sorted(r.ids_crc32 for r in got if r.doc_id == i) == want
    assert tokens.token_file_round_trip(docs.limit(0), vocabulary_file()).count() == 0
