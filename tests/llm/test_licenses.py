"""Licence scan: phrase places by regular expression, template matches by all block pairs."""

import math
import random

import pytest

from cinerank.llm import licenses as S
from tests.llm.conftest import prose
from tests.llm.test_text import words_of


def brute(text, threshold=S.THRESHOLD, block=S.BLOCK_WORDS):
    w = words_of(text or "", "alnum")
    base = sorted((i, label) for p, label in S.PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
    found = set()
    for b in range(0, max(1, math.ceil(len(w) / (block // 2)))):
        own = set(w[b * block // 2:b * block // 2 + block])
        for label, t in S.TEMPLATES:
            t = set(words_of(t, "alnum"))
            if own and len(own & t) >= math.ceil(threshold * len(t) - 1e-9):
                found.add((label, b * block // 2, len(own & t) / len(t)))
    return len(w), base, found


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(10)
    rows = []
    for i in range(60):
        parts = [prose(rng, rng.randint(0, 150))]
        for _ in range(rng.randint(0, 2)):
            t = rng.choice(S.TEMPLATES)[1].split()
            for _ in range(rng.randint(0, 3)):
                del t[rng.randrange(len(t))]
            parts.append(" ".join(t))
            parts.append(rng.choice(["under the MIT license", "UNDER-THE MIT_license mit", "cc by/nc", "cc by", "x"]))
            parts.append(prose(rng, rng.randint(0, 90)))
        rows.append((i, "\n".join(parts)))
    return rows + [(100, None), (101, ""), (102, "¿!"), (103, "Under The MIT License"), (103, "Under The MIT License"),
                   (None, "cc by nc cc by nc"), (104, "apache license version 2 " * 400), (105, prose(rng, 20000))]


def test_equals_brute_force(docs, cases):
    got = S.scan_licenses(docs(cases, extra=True)).collect()
    assert len(got) == len(cases)
    want = sorted((i, *brute(t)) for i, t in cases if i is not None)
    seen = sorted((r.doc_id, r.n_words, list(zip(r.base_starts, r.base_labels)),
                   set(zip(r.match_labels, r.match_starts, r.match_scores))) for r in got if r.doc_id is not None)
    assert seen == want
    assert any(x[3] for x in want)
    null = [r for r in got if r.doc_id is None]
    assert [(r.n_words, r.base_starts) for r in null] == [(6, [0, 3])]


def test_options_and_empty_table(docs):
    assert S.scan_licenses(docs([])).collect() == []
    got = S.scan_licenses(docs([(1, "a b c d")]), templates=(("t", "a b c x"),), phrases=(("b c", "bc"),), threshold=0.75)
    r = got.first()
    assert (r.base_starts, r.base_labels, r.match_labels, r.match_scores) == ([1], ["bc"], ["t"], [0.75])
    assert S.scan_licenses(docs([(1, "a")]), templates=(), phrases=()).first().match_labels == []


def test_long_templates_match_wherever_they_stand(docs):
    """Passages of 100 and 300 words, over half a block and over a block, at any offset and with a word missing."""
    long = {n: " ".join(f"t{n}x{i}" for i in range(n)) for n in (100, 300)}
    rng = random.Random(24)
    rows = [(n * 1000 + k, prose(rng, k) + " " + t.replace(f" t{n}x50 ", " ") + " " + prose(rng, 40))
            for n, t in long.items() for k in range(0, 330, 30)]
    rows.append((1, " ".join(long[300].split()[:200])))  # two thirds are not enough
    got = S.scan_licenses(docs(rows), templates=S.TEMPLATES + tuple((str(n), t) for n, t in long.items())).collect()
    assert {r.doc_id: set(r.match_labels) for r in got} == \
        {i: {str(i // 1000)} if i > 1 else set() for i, _ in rows}
