"""The encoder by parts gives what the tokenizer gives for whole texts."""

import random

import numpy as np
import pytest

from marketloom.llm import token_files

PIECES = [
    " ", "  ", "\n", "\n\n", "\t", "a", "é", "ß", "Ω", "word", "Word", "12", "²", "'s", "'ll", "'", "<|endoftext|>", "<", "|", ".", "!!", "_", "-",
    "中", "😀", "\r\n", "\x1c", " ", " ", "10%", "×", "÷", "ª", "́", "",
]


@pytest.mark.parametrize("kept", [50, 200_000])
def test_parts_agree_with_whole_texts(monkeypatch, kept):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "CACHED_PARTS", kept)
    path, rng = token_files.vocabulary(), random.Random(5)
    tokenizer, encoder = Tokenizer.from_file(path), token_files.Encoder(path)
    assert encoder.by_parts
    texts = ["".join(rng.choices(PIECES, k=rng.randrange(30))) for _ in range(8_000)]
    for k in range(0, len(texts), 1_000):
        for text, ids in zip(texts[k:k + 1_000], encoder.encode(texts[k:k + 1_000])):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_other_tokenizers_take_whole_texts(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    other = Tokenizer(models.WordLevel({"a": 1, "b": 2, "[UNK]": 0}, "[UNK]"))
    other.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    other.save(str(tmp_path / "words.json"))
    encoder = token_files.Encoder(str(tmp_path / "words.json"))
    assert not encoder.by_parts
    assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(["a b\na", "", "c"])] == [[1, 2, 1], [], [0]]


def test_parts_are_looked_up_once_and_long_ones_are_not_kept():
    from tokenizers import Tokenizer

    class Counted(dict):
        looked_up = 0

        def __getitem__(self, key):
            Counted.looked_up += 1
            return super().__getitem__(key)

        def get(self, key, default=None):
            Counted.looked_up += 1
            return super().get(key, default)

    path = token_files.vocabulary()
    encoder, tokenizer = token_files.Encoder(path), Tokenizer.from_file(path)
    encoder.cache = Counted(encoder.cache)
    texts = ["a word and 12 " * 500, "中" * 5_000, "x" * 3_000]
    found = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)]
    assert found == [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert Counted.looked_up < 20
    assert max(map(len, encoder.cache)) < 100


def test_vocabulary_without_some_bytes(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    small = Tokenizer(models.BPE({"a": 0, "b": 1, "ab": 2, "Ġ": 3}, [("a", "b")]))
    small.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    small.save(str(tmp_path / "small.json"))
    encoder = token_files.Encoder(str(tmp_path / "small.json"))
    assert encoder.by_parts
    texts = ["ab xab ba", "xyz", "", "ab\nab 1"]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)] == [small.encode(text).ids for text in texts]


def test_white_space_outside_ascii():
    from tokenizers import Tokenizer

    path = token_files.vocabulary()
    encoder, tokenizer = token_files.Encoder(path), Tokenizer.from_file(path)
    spaces = [*map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0x1C, 0x1F)), "“", "あ", "ž"]
    texts = [f"a{left}{space}{right}b" for space in spaces for left in ("", " ", "\n") for right in ("", " ", "\n", "\n ")]
    texts += [f"a {space}" for space in spaces]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)] == [
        tokenizer.encode(text, add_special_tokens=False).ids for text in texts
    ]
