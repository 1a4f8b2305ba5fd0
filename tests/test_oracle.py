"""Every query that has SQL, on the small tables, against DuckDB."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry_points
from tests.conftest import ROOT, SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
# the text queries have tests of their own
QUERIES = {n: q for n, q in entry_points.queries().items() if n not in entry_points.TEXT}
SQL = {n: s for n, s in entry_points.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def plain(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        return round(v, 6) if isinstance(v, float) else v

    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def test_names():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    want = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert plain(df.columns, [tuple(r) for r in df.collect()]) == plain(want.columns, want.fetchall())


@pytest.mark.parametrize("stream, batch, columns", [
    ("i01_tracks_stream", "i01_centroid_tracks", ["camera_id", "frame_number", "det_id", "track_id", "is_new"]),
    ("i04_repeats_stream", "d12_without_repeats_exact", ["camera_id", "ts_sec", "det_id"]),
    ("i05_helmet_stream", "i05_helmet_violations", ["camera_id", "frame_number", "track_id", "method"]),
])
def test_stream_equals_batch(spark, stream, batch, columns):
    a = QUERIES[stream](spark, SMALL).select(*columns).collect()
    b = QUERIES[batch](spark, SMALL).select(*columns).collect()
    assert a and sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_rows_only_queries_have_rows(spark):
    for name in set(QUERIES) - set(SQL):
        assert QUERIES[name](spark, SMALL).take(1), name


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["camera_id", "hour", "line_id", "crossings"]


def test_workers_find_the_package(tmp_path):
    """Rules run although the session was started in a folder from which the package cannot be imported."""
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as e
from kerbwatch.session import build_session
spark = build_session("elsewhere", "local[2]", **{{"spark.sql.shuffle.partitions": "2"}})
print("rows", e.queries()["i01_centroid_tracks"](spark, {SMALL!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows" in done.stdout, done.stderr[-2000:]
