"""Hard negatives against brute force; bounds against exact scores; odd rows."""

import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbwatch.llm import negatives, queries
from kerbwatch.session import materialise
from tests.conftest import SMALL


def vectors(v, labels=None):
    v = np.asarray(v, np.int64)
    v = np.pad(v, ((0, 0), (0, -v.shape[1] % negatives.SEGMENTS)))
    return negatives.Vectors(np.arange(len(v)), np.zeros(len(v), int) if labels is None else labels, v, *negatives.summarise(v))


def test_bounds_hold_and_close_pairs(monkeypatch):
    rng = np.random.default_rng(1)
    # runs of like components: means say much, so few pairs are left for the exact score
    a, b = (vectors(np.repeat(rng.integers(-90, 90, (n, 8)), 8, axis=1) + rng.integers(-3, 3, (n, 64))) for n in (40, 500))
    exact = a.v @ b.v.T
    for (ma, da), (mb, db) in zip(a.levels, b.levels):
        length = a.v.shape[1] // ma.shape[1]
        middle, reach = length * (ma @ mb.T), length * (da @ db.T)
        assert (exact <= middle + reach + 1e-6).all() and (exact >= middle - reach - 1e-6).all()
    low, high = np.full(40, np.quantile(exact, 0.97).astype(int)), np.full(40, int(exact.max() * 0.9))
    scored, plain = [], negatives.scores
    monkeypatch.setattr(negatives, "scores", lambda x, y, i=None, j=None: scored.append(len(x) * len(y) if i is None else len(i)) or plain(x, y, i, j))
    i, j, s = negatives.open_pairs(a, b, low, high, np.ones(exact.shape, bool))
    want = {(x, y) for x, y in zip(*np.nonzero((exact >= low[:, None]) & (exact <= high[:, None])))}
    assert want <= set(zip(i.tolist(), j.tolist())) and (s == exact[i, j]).all() and sum(scored) < exact.size / 4


def test_scores_beyond_doubles():
    a = vectors([[1 << 40, 3], [1 << 62, 1 << 62]])
    assert negatives.scores(a, a)[0].tolist() == [(1 << 63) - 1, (1 << 63) - 1]
    b = vectors([[1 << 29, 1]])
    assert negatives.scores(b, b).tolist() == [[(1 << 58) + 1]]


def plain(rows, is_anchor):
    best = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and None not in v:
            best[i] = min(best.get(i, (label, v)), (label, v))
    dot = lambda x, y: sum(a * b for a, b in zip(x, y))
    out = []
    for a, (label, v) in best.items():
        if not is_anchor(a):
            continue
        scored = sorted((-dot(v, w), i, m) for i, (m, w) in best.items() if i != a)
        for p, i, _ in [x for x in scored if x[2] == label][:5]:
            good = [x for x in scored if x[2] != label and 30 * -p <= 100 * -x[0] <= 90 * -p][:10]
            out += [(a, i, r + 1, x[1], -p, -x[0]) for r, x in enumerate(good)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    near = rng.normal(0, 40, (6, 20))
    out = [(i, int(i % 6), [int(x) for x in near[i % 5] + rng.normal(0, 30, 20)]) for i in range(300)]
    out += [(i, 3, out[7][2]) for i in range(300, 340)]  # ties
    out += [out[10], out[10], (11, 0, [5] * 20), (None, 1, [1] * 20), (400, None, [1] * 20), (401, 1, None), (410, 2, [1, None]),
            (420, 2, []), (430, 2, [9] * 3), (440, 1, [200] * 37), (450, 0, [0] * 20)]
    return out


def test_against_brute_force(spark, rows, monkeypatch):
    docs = spark.createDataFrame([(*r, "a", 1, 2) for r in rows], "id bigint, label bigint, v array<bigint>, summary string, anchor int, rank int")
    docs = materialise(docs.repartition(5), "vectors")
    want = plain(rows, lambda i: i % 10 == 0)
    assert len(want) > 300
    assert sorted(map(tuple, negatives.mine(docs, F.col("id") % 10 == 0).collect())) == want
    for name, value in (("PASS_BYTES", 32 * 8 * 9), ("ANCHORS", 4), ("ROWS", 16), ("FIRST_ROWS", 3)):
        monkeypatch.setattr(negatives, name, value)
    assert sorted(map(tuple, negatives.mine(docs, F.col("id") % 10 == 0).collect())) == want
    assert negatives.mine(docs.where("false"), F.col("id") % 10 == 0).count() == 0


def test_against_sql(spark, tmp_path):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW source AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    con.execute(f"""COPY (SELECT vec_id, CASE WHEN vec_id % 9 = 1 THEN NULL WHEN vec_id % 9 = 2 THEN list_append(embedding[1:5], 'nan'::FLOAT)
      WHEN vec_id % 9 = 3 THEN list_append(embedding[1:5], NULL) ELSE embedding END AS embedding,
      CASE WHEN vec_id % 9 = 4 THEN NULL ELSE label END AS label FROM source) TO '{tmp_path / "embeddings.parquet"}'""")
    for folder in (SMALL, str(tmp_path)):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{os.path.join(folder, 'embeddings.parquet')}'")
        want = con.sql(queries.SQL["op12_hard_negatives"])
        got = queries.QUERIES["op12_hard_negatives"](spark, folder)
        assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(want.fetchall()) != []
