"""Line dedup against a plain statement of its rule."""

import random

import pytest

from cinerank.llm import line_dedup as L
from tests.llm.conftest import prose


def brute(rows, window, long_chars):
    """rows: (id, text), unique; returns {(id, text): (text left, n_lines, n_removed)}."""
    first, gone = {}, {}
    for doc, text in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is not None, r[0] or 0)):
        units = []
        for i, x in enumerate(text.split("\n")):
            if x.strip(" "):
                units.append((i, x))
                if len(x) >= long_chars:
                    units.append((i, x + "\0second half"))
        for j in range(len(units) - window + 1):
            key = tuple(u for _, u in units[j:j + window])
            if first.setdefault(key, (doc, text, j)) != (doc, text, j):
                gone.setdefault((doc, text), set()).update(i for i, _ in units[j:j + window])
    out = {}
    for doc, text in rows:
        lines = [] if not text else text.split("\n")
        cut = gone.get((doc, text), set())
        left = None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in cut)
        out[doc, text] = (left, len(lines), len(cut))
    return out


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(9)
    pool = [prose(rng, rng.randint(1, 30)) for _ in range(25)] + ["", " ", "same", "same"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))) for i in range(60)]
    run = "\n".join(prose(rng, 4) for _ in range(6))
    rows += [(100, "a\n" + run + "\nb"), (101, run), (102, "c\n" + run), (103, run + "\n" + run), (104, None), (105, ""),
             (106, "\n\n"), (None, run), (107, prose(rng, 60)), (108, "x\n" + rows[0][1]), (-5, "late id first\n" + run),
             (109, "\n".join(["again"] * 500)), (110, "\n".join(f"line {i % 40}" for i in range(3000)))]
    return rows


@pytest.mark.parametrize("window,long_chars", [(L.WINDOW, L.LONG_CHARS), (4, 20)])
def test_equals_rule(docs, cases, window, long_chars):
    want = brute(cases, window, long_chars)
    got = L.dedup_lines(docs(cases), window=window, long_chars=long_chars).collect()
    by_id = {i: v for (i, _), v in want.items()}
    assert len(got) == len(cases)
    assert {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in got} == by_id


def test_repeated_rows_are_one_document(docs):
    text = "first line here\nsecond line here\nthird"
    rows = [(1, text), (1, text), (2, text), (2, "other text of the same id\nthird")]
    got = sorted((r.doc_id, r.text, r.n_removed) for r in L.dedup_lines(docs(rows)).collect())
    assert got == [(1, text, 0), (1, text, 0), (2, "", 3), (2, "other text of the same id\nthird", 0)]


def test_single_long_line_and_single_short_line(docs):
    long, short = "word " * 60, "All rights reserved."
    rows = [(1, f"a\n{long}\nb\n{short}\nc"), (2, f"d\n{long}\ne\n{short}\nf")]
    got = {r.doc_id: r.text for r in L.dedup_lines(docs(rows)).collect()}
    assert got[1] == rows[0][1] and got[2] == f"d\ne\n{short}\nf"


def test_one_line_of_several_words_is_a_run(docs):
    line = "Terms apply to every visit here"
    rows = [(i, f"start {i}\n{line}\nend {i}") for i in range(4)]
    got = {r.doc_id: r.text for r in L.dedup_lines(docs(rows)).collect()}
    assert got[0] == rows[0][1] and all(got[i] == f"start {i}\nend {i}" for i in range(1, 4))


def test_only_selected_minima_are_written_and_decide(docs, monkeypatch):
    """Fewer rows than windows, each selected by its windows; without the fingerprints nothing is found."""
    rng = random.Random(10)
    text = "\n".join(prose(rng, 3) for _ in range(900))
    rows = [(1, text), (2, "before\n" + text + "\nafter")]
    written = {}
    real = L.materialize
    monkeypatch.setattr(L, "materialize", lambda df, name: written.setdefault(name, real(df, name)))
    got = {r.doc_id: r.text for r in L.dedup_lines(docs(rows), long_chars=10_000).collect()}
    assert got == {1: text, 2: "before\nafter"}
    table = written["line-fingerprints"]
    windows = 899 + 901
    assert table.count() < 0.72 * windows and table.selectExpr("sum(size(windows))").first()[0] == windows
    monkeypatch.setattr(L, "materialize", lambda df, name: real(df.withColumn("fp", L.F.expr("xxhash64(doc_id, at)")), name))
    assert all(r.n_removed == 0 for r in L.dedup_lines(docs(rows)).collect())


def test_columns_and_empty_table(docs):
    df = docs([(1, "a\nb"), (2, "a\nb")], extra=True)
    out = L.dedup_lines(df)
    assert out.columns == df.columns + ["n_lines", "n_removed"]
    assert sorted(tuple(r)[:2] for r in out.collect()) == [(1, "a\nb"), (2, "")]
    assert L.dedup_lines(docs([])).collect() == []


def test_no_python_on_the_main_path(docs):
    plan = L.dedup_lines(docs([(1, "a\nb")]))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
