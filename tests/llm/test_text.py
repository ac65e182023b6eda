"""Word hashing against regular expressions."""

import random
import re

import numpy as np

from cinerank.llm import text

PATTERN = {"space": "[^\x20\x09-\x0D]+", "alnum": "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"}
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(t: str, kind: str) -> list[str]:
    return re.findall(PATTERN[kind], t.translate(LOWER))


def test_words_match_patterns():
    rng = random.Random(3)
    alphabet = "abCDé ß\t\n\x0b\x1f.,-_09\x00中🙂\x7f"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(500)] + ["", " ", "a"]
    for kind in PATTERN:
        h, counts = text.hash_words([t.encode() for t in texts] + [None], kind)
        expected = [w for t in texts for w in words_of(t, kind)]
        assert counts.tolist() == [len(words_of(t, kind)) for t in texts] + [0]
        seen = {}
        for w, x in zip(expected, h.tolist()):
            assert seen.setdefault(w, x) == x
        assert len(set(seen.values())) == len(seen)


def test_long_text_is_cut_between_words(monkeypatch):
    rng = random.Random(4)
    t = " ".join("w" * rng.randint(1, 9) + str(rng.randint(0, 99)) for _ in range(2000)).encode()
    whole = text.hash_words([b"x", t, b"y z"], "space")
    monkeypatch.setattr(text, "PIECE", 128)
    cut = text.hash_words([b"x", t, b"y z"], "space")
    assert (whole[0] == cut[0]).all() and whole[1].tolist() == cut[1].tolist()
    one = text.hash_words([b"q" * 1000], "space")  # a word longer than a piece stays whole
    assert one[1].tolist() == [1]


def test_packed_keys_round_trip():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2))
    assert (text.unpack_sorted(text.pack_sorted(keys)) == keys).all()
    assert len(text.unpack_sorted(text.pack_sorted(keys[:0]))) == 0
