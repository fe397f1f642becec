"""Word and run hashes without word objects against plain ones."""

import random

import numpy as np
import pytest

from paperloom.llm import words


def same_partition(a, b):
    pairs = set(zip(a.tolist(), b.tolist(), strict=True))
    return len({x for x, _ in pairs}) == len({y for _, y in pairs}) == len(pairs)


@pytest.mark.parametrize("piece", [1 << 20, 40, 1])
def test_word_arrays_know_the_same_words(monkeypatch, piece):
    monkeypatch.setattr(words, "_PIECE", piece)
    pick = random.Random(piece)
    texts = [
        "".join(pick.choice("abÉ  \n\t\x0b\x0c\r\x00") for _ in range(pick.randrange(60))).encode()
        for _ in range(300)
    ] + [b"", b" \n", b"x" * 500 + b" y", b" lead trail ", b"a", b"aa", b"\xff\xfe bad"]
    hashes, ends = words.word_arrays(texts)
    plain, plain_ends = words.texts_to_words(texts)
    assert ends.tolist() == plain_ends.tolist()
    assert same_partition(hashes, plain)
    assert [len(x) for x in words.word_arrays([])] == [0, 1]
    assert words.word_arrays([b""])[1].tolist() == [0, 0]


@pytest.mark.parametrize("size", [1, 3, 35])
def test_run_hashes_know_the_same_runs(size):
    letters = np.random.default_rng(size).integers(0, 3, 200_000).astype(np.uint64)
    hashes = words.mix(letters + np.uint64(7))
    for base in words.BASES:
        got, plain = words.run_hashes(hashes, size, base), words.windows(hashes, size)
        assert len(got) == len(plain) and same_partition(got, plain)
    assert len(words.run_hashes(hashes[: size - 1], size)) == 0
    assert len(words.run_hashes(hashes[:size], size)) == 1
