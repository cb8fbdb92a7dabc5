"""Texts split together, by and by, and with pieces forgotten on the way give the ids of the plain call."""

import random

import numpy as np

from gridloom.llm import tokens


def test_chunks():
    assert list(tokens.chunks(["ab", "", "cde", "f"], 3)) == [["ab", "", "cde"], ["f"]]
    assert list(tokens.chunks([], 3)) == []


def test_long_texts_and_small_memory(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "CHUNK", 400)
    monkeypatch.setattr(tokens, "CACHE_WORDS", 50)
    monkeypatch.setattr(tokens, "_LINES", 7)
    rng = random.Random(3)
    letters = "abcé ß, .\n\t-1 '　\U0001f600"
    texts = ["".join(rng.choices(letters, k=rng.choice([0, 1, 30, 399, 400, 401, 3000]))) for _ in range(120)]
    texts += ["x" * 2000, " " * 1500, "a<|endoftext|>b" * 60, ""]
    path = tokens.default_tokenizer()
    e, plain = tokens.Encoder(path), Tokenizer.from_file(path)
    want = [plain.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    for _ in range(2):
        got = e.texts(texts, 2)
        assert [list(memoryview(b).cast("H")) for b in got] == want
    assert len(e.known) <= 50 + len({w for t in texts for w in tokens._PIECES.findall(t)})


def test_known_pieces_are_looked_up_in_place(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 50)
    enc = tokens.Encoder(tokens.default_tokenizer())
    r = random.Random(4)
    bits = ["a", "b c", "é", " ", "  ", "\n", "\t", "　", ",", ".", "'s", "12", "½", "中", "́", "\r\n", "-", "<|endoftext|>"]
    for _ in range(20):
        texts = ["", "  ", " \n ", *["".join(r.choice(bits) for _ in range(r.randint(1, 30))) for _ in range(100)]]
        want = [np.array([*enc.model.encode(t, add_special_tokens=False).ids, 2], enc.dtype).tobytes() for t in texts]
        assert enc.texts(texts, 2) == want
    # what is kept is looked into as it is, without a table of its own for each run of texts
    assert enc._look_up({" a", " bc"}) is enc.known
