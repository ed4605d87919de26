import random

import numpy as np
import public_tokenizers
import pytest

from surge.llm.tokens import PieceEncoder

PARTS = [*"ab Z9!.'\n\t -_", "é", "ß", "×", "÷", "Ж", "ж", "\u00a0", "\u3000", "日", "\U0001f600", "  ", "\n\n", "'s", "'ll", " '", "don't", "\u0301",
         "\x00", "\r\n", "ÿ", "<|endoftext|>", "\u2003", "\x85", "1a", "a1!", " \n ", "word, ", "Ünïcode "]


@pytest.mark.parametrize("name,kind", [("byte_bpe_50k.json", "<u2"), ("byte_bpe_50k.json", "<u4"), ("word_bpe_49k.json", "<u2")])
def test_ids_equal_the_library(name, kind):
    """Random texts of every kind of character give the library's ids, with this vocabulary and with one of another kind."""
    encoder = PieceEncoder(str(public_tokenizers.path(name)), kind)
    assert encoder.plain == name.startswith("byte")
    rng = random.Random(7)
    for _ in range(60):
        texts = ["".join(rng.choices(PARTS, k=rng.randrange(25))) for _ in range(40)]
        want = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
        for text, got, w in zip(texts, encoder.encode(texts), want, strict=True):
            assert np.frombuffer(got, kind).tolist() == w.ids, repr(text)
    assert encoder.encode([]) == [] and encoder.encode(["", ""]) == [b"", b""]


def test_two_bytes_need_a_small_vocabulary(tmp_path):
    from tokenizers import Tokenizer, models
    file = tmp_path / "large.json"
    Tokenizer(models.WordLevel({f"w{i}": i for i in range(65_537)}, unk_token="w0")).save(str(file))
    assert PieceEncoder(str(file), "<u4").plain is False
    with pytest.raises(ValueError, match="id_bytes"):
        PieceEncoder(str(file), "<u2")
