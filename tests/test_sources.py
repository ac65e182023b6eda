"""CSV source with declared schema, sinks, and the all-methods run."""

import glob
import os
import tempfile

from cinerank.plans.pipeline import run_all
from cinerank.sources import read_catalog, read_ratings, write_recommendations, write_report


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_csv_reader_types_and_cleaning(spark):
    d = tempfile.mkdtemp(prefix="cinerank-csv-")
    _write(f"{d}/ratings.csv", "userId,movieId,rating,timestamp\n1,10,4.5,100\n1,11,NaN,101\n2,10,,102\n2,11,3.0,103\n")
    _write(f"{d}/movies.csv", 'movieId,title,genres\n10,"Heat, The",Action|Crime\n11,Up,(no genres listed)\n')
    r = read_ratings(spark, f"{d}/ratings.csv")
    c = read_catalog(spark, f"{d}/movies.csv")
    assert r.dtypes == [("userId", "bigint"), ("movieId", "bigint"), ("rating", "double"), ("ts", "bigint")]
    assert sorted(tuple(x) for x in r.na.drop().collect()) == [(1, 10, 4.5, 100), (2, 11, 3.0, 103)]
    assert [tuple(x) for x in c.orderBy("movieId").collect()] == [
        (10, "Heat, The", "Action|Crime"), (11, "Up", "(no genres listed)")]


def test_csv_columns_by_name(spark):
    import pytest
    d = tempfile.mkdtemp(prefix="cinerank-csv-")
    _write(f"{d}/a.csv", "movieId,extra,userId,rating,timestamp\n10,x,1,4.5,100\n")
    assert [tuple(x) for x in read_ratings(spark, f"{d}/a.csv").collect()] == [(1, 10, 4.5, 100)]
    _write(f"{d}/b.csv", "userId,movieId,rating\n1,10,4.5\n")
    with pytest.raises(ValueError, match="timestamp"):
        read_ratings(spark, f"{d}/b.csv")
    _write(f"{d}/c.csv", "userId,movieId,rating,timestamp\n1,10,abc,100\n1,11,,100\n")
    with pytest.raises(Exception, match="rating is no double: abc"):
        read_ratings(spark, f"{d}/c.csv").collect()
    lenient = read_ratings(spark, f"{d}/c.csv", on_bad="null").collect()
    assert [x.rating for x in lenient] == [None, None]


def test_short_long_and_unparsable_rows_are_seen(spark):
    import pytest
    from cinerank.sources import reject_counts, rejected_catalog, rejected_ratings
    d = tempfile.mkdtemp(prefix="cinerank-csv-")
    _write(f"{d}/r.csv", "userId,movieId,rating,timestamp\n1,10,4.5,100\n2,11,3.0\n3,12,3.0,101,extra\n4,x,2.0,102\n5,13,,103\n6,14,y,z\n")
    good = [(1, 10, 4.5, 100), (5, 13, None, 103)]
    assert sorted(tuple(x) for x in read_ratings(spark, f"{d}/r.csv", on_bad="reject").collect()) == good
    bad = rejected_ratings(spark, f"{d}/r.csv")
    assert sorted((r.userId, r.kind, r.reason) for r in bad.collect()) == [
        ("2", "wrong number of fields", "wrong number of fields: 2,11,3.0"),
        ("3", "wrong number of fields", "wrong number of fields: 3,12,3.0,101,extra"),
        ("4", "movieId is no long", "movieId is no long: x"), ("6", "rating is no double", "rating is no double: y")]
    assert {r.kind: r.n for r in reject_counts(bad).collect()} == {
        "wrong number of fields": 2, "movieId is no long": 1, "rating is no double": 1}
    lenient = {r.userId: tuple(r) for r in read_ratings(spark, f"{d}/r.csv", on_bad="null").collect()}
    assert len(lenient) == 6 and lenient[4] == (4, None, 2.0, 102) and lenient[6] == (6, 14, None, None)
    assert lenient[2][3] is None and lenient[3] == (3, 12, 3.0, 101)
    # counting a single column sees the same rows
    assert read_ratings(spark, f"{d}/r.csv", on_bad="reject").select("userId").count() == 2
    for line in ("2,11,3.0", "3,12,3.0,101,extra"):
        _write(f"{d}/one.csv", f"userId,movieId,rating,timestamp\n1,10,4.5,100\n{line}\n")
        with pytest.raises(Exception, match="wrong number of fields"):
            read_ratings(spark, f"{d}/one.csv").collect()
    _write(f"{d}/m.csv", 'movieId,title,genres\n10,"Heat, The",Action|Crime\n11,Up\n')
    assert [r.movieId for r in read_catalog(spark, f"{d}/m.csv", on_bad="reject").collect()] == [10]
    assert [(r.kind, r.movieId, r.title) for r in rejected_catalog(spark, f"{d}/m.csv").collect()] == [
        ("wrong number of fields", "11", "Up")]
    with pytest.raises(ValueError, match="on_bad"):
        read_ratings(spark, f"{d}/r.csv", on_bad="skip")


def test_run_all_goes_on_after_a_failure(spark, frames, monkeypatch):
    import pytest
    from cinerank.plans import pipeline
    from cinerank.plans.stages import Stages, fingerprint
    rows = [(u, m, float(1 + (u * m) % 5), u + m) for u in range(1, 9) for m in range(1, 9) if (u + m) % 3]
    cat = [(m, f"t{m}", "A|B" if m % 2 else "B") for m in range(1, 9)]
    r, c = frames(rows, cat)
    want = sorted(map(tuple, run_all(r, c, n=3, k=5, vocabulary=("A", "B"), prepared=True).collect()))
    d = tempfile.mkdtemp(prefix="cinerank-run-")
    call = lambda ratings, n=3: run_all(ratings, c, n=n, k=5, vocabulary=("A", "B"), prepared=True, run_dir=d)
    seen = []
    real, real_top = Stages.table, pipeline.content_top_n
    monkeypatch.setattr(Stages, "table", lambda self, name, build: (seen.append((self, name)), real(self, name, build))[1])

    def fail(*a, **k):
        raise RuntimeError("lost")

    monkeypatch.setattr(pipeline, "content_top_n", fail)
    with pytest.raises(RuntimeError, match="lost"):
        call(r)
    first = seen[0][0]
    assert {"prepared", "catalog", "neighbors", "top-random", "top-item_based"} <= set(first.computed)
    assert "top-content" not in first.computed
    assert {x.stage for x in first.manifest().collect()} == set(first.computed)
    monkeypatch.setattr(pipeline, "content_top_n", real_top)
    seen.clear()
    shuffled = r.orderBy(pipeline.F.rand(1))  # the same rows in another order are the same input
    assert sorted(map(tuple, call(shuffled).collect())) == want
    again = seen[0][0]
    assert again.root == first.root and not set(again.computed) & set(first.computed) and "top-content" in again.computed
    seen.clear()
    assert sorted(map(tuple, call(r).collect())) == want and seen[0][0].computed == []
    # a stage whose table was cut off is computed again; other rows or parameters make another run
    os.remove(f"{first.root}/top-random/_SUCCESS")
    seen.clear()
    assert sorted(map(tuple, call(r).collect())) == want and seen[0][0].computed == ["top-random"]
    assert fingerprint(r) != fingerprint(r.limit(3)) and fingerprint(r) == fingerprint(shuffled)
    seen.clear()
    call(r, 2)
    assert seen[0][0].root != first.root


def test_sinks_and_run_all(spark, frames):
    rows = [(u, m, float(1 + (u * m) % 5), u + m) for u in range(1, 9) for m in range(1, 9) if (u + m) % 3]
    cat = [(m, f"t{m}", "A|B" if m % 2 else "B") for m in range(1, 9)]
    r, c = frames(rows, cat)
    out = run_all(r, c, n=3, k=5, vocabulary=("A", "B"), prepared=True)
    got = out.collect()
    assert {x.method for x in got} == {"random", "item_based", "content", "hybrid"}
    assert all(x.rnk <= 3 for x in got)
    seen = {(u, m) for u, m, _, _ in rows}
    assert not any((x.userId, x.movieId) in seen for x in got)

    d = tempfile.mkdtemp(prefix="cinerank-out-")
    write_recommendations(out, f"{d}/recs")
    assert spark.read.parquet(f"{d}/recs").count() == len(got)
    lines = spark.createDataFrame([(2, "b"), (0, "t"), (1, "a")], "line_no int, value string")
    write_report(lines, f"{d}/report")
    parts = [p for p in glob.glob(f"{d}/report/part-*") if os.path.getsize(p) > 0]
    assert len(parts) == 1
    assert open(parts[0]).read().splitlines() == ["t", "a", "b"]


def test_cleanup_removes_written_tables(spark):
    from cinerank.session import cleanup, materialize
    cleanup(spark)
    df = materialize(spark.range(5), "probe")
    path = df.inputFiles()[0].rsplit("/", 1)[0].replace("file:", "")
    assert os.path.isdir(path)
    assert cleanup(spark) == 1
    assert not os.path.exists(path)
