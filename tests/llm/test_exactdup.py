"""Exact duplicates: the filter against counts, rows against plain grouping, colliding fingerprints."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbwatch.llm import common, exactdup
from kerbwatch.session import materialise

ROWS = [(1, None), (2, ""), (3, "a"), (4, "a"), (5, "b "), (6, "b"), (7, "long " * 9000), (8, "long " * 9000), (4, "a"), (None, "a"), (None, None),
        (None, "only null ids"), (None, "only null ids"), (9, "only once"), (9, "same id, other text"), (10, "top"), (10, "top"), (2, "top")]


@pytest.mark.parametrize("n, most", [(0, 2), (1, 2), (1, 1 << 45), (50, 3), (4000, 2), (4000, 1 << 40)])
def test_filter_gives_back_what_was_filed(n, most):
    rng = np.random.default_rng(n)
    fp = np.unique(np.r_[rng.integers(0, 1 << exactdup.BITS, n), [0, (1 << exactdup.BITS) - 1][:n]].astype(np.uint64))
    count = rng.integers(1, most, len(fp)).astype(np.int64)
    a, b = exactdup.Filter.unpack(exactdup.Filter.pack(fp, count))
    assert a.tolist() == fp.tolist() and b.tolist() == count.tolist()
    both = exactdup.merge([(a, b), (fp[::2], count[::2])])
    assert both[0].tolist() == fp.tolist() and both[1].sum() == count.sum() + count[::2].sum()


def plain(rows):
    out = []
    for k, t in rows:
        same = [x for x, s in rows if (s or "") == (t or "")]
        ids = [x for x in same if x is not None]
        out.append((k, max(ids) if ids else None, len(same), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def check(docs, rows):
    got = exactdup.report(docs).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == plain(rows)
    kept = [(r.doc_id, r.text_sha256) for r in got if r.kept]
    assert len(kept) == len({s for _, s in kept}) == len({t or "" for _, t in rows})
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got if r.group_size == 1)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


@pytest.fixture(scope="module")
def docs(spark):
    wide = [(k, t, 1, "a", "b", "c", "d") for k, t in ROWS]
    return materialise(spark.createDataFrame(wide, "doc_id bigint, text string, h int, sha string, row string, value string, n string").repartition(5), "odd")


def test_report(docs):
    check(docs, ROWS)
    assert exactdup.report(docs.where("false")).count() == 0


def test_fingerprints_that_collide_and_small_parts(docs, monkeypatch):
    monkeypatch.setattr(exactdup, "fingerprint", lambda value: (F.length(value) % 4).cast("bigint") * (1 << 50))
    monkeypatch.setattr(exactdup, "HELD", 2)
    monkeypatch.setattr(exactdup, "SHARD", 3)
    monkeypatch.setattr(common, "HEAVY", 6)
    check(docs, ROWS)


def test_one_of_each(docs):
    got = exactdup.one_of_each(docs)
    assert got.columns == docs.columns and sorted({r.text or "" for r in got.collect()}) == sorted({t or "" for _, t in ROWS})
    assert got.count() == len({t or "" for _, t in ROWS})
    folded = exactdup.one_of_each(docs, normalise=F.trim)
    assert folded.where("text IN ('b', 'b ')").count() == 1
