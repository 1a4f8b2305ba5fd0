"""Null, repeated, sparse and textual ids in the operators that put rows in order or join them by id."""

import hashlib

import pytest

from kerbwatch.llm import longdup, prints
from kerbwatch.session import materialise
from tests.llm.test_llm import LONG, WORDS

A, B = " ".join(WORDS * 8), LONG[:1500]
TEXTS = [(None, A + " x"), (None, B), (None, None), (None, A + " x"), (3, A), (3, "another text under the same id " + B), (3, "another text under the same id " + B),
         (900_000_000_000, A[:430]), (-7, B[300:900] + A[50:600]), (0, "short one"), (256, ""), (257, "é😀 " * 30)]


def frame(spark, kind):
    change = (lambda k: k) if kind == "bigint" else (lambda k: None if k is None else f"doc {k}")
    rows = [(change(k), t, 1, 2) for k, t in TEXTS]
    df = spark.createDataFrame(rows, f"doc_id {kind}, text string, lot int, first int").repartition(4)
    return materialise(df, "odd-ids"), [(change(k), t or "") for k, t in TEXTS]


def removed(rows):
    raw = [t.encode() for _, t in rows]
    count = {}
    for b in raw:
        for s in range(len(b) - 399):
            count[b[s:s + 400]] = count.get(b[s:s + 400], 0) + 1
    out = []
    for (k, _), b in zip(rows, raw):
        gone = [False] * len(b)
        for s in range(len(b) - 399):
            if count[b[s:s + 400]] > 1:
                gone[s:s + 400] = [True] * 400
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((k, len(b), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_long_repeats(spark, kind):
    df, rows = frame(spark, kind)
    got = longdup.report(df).select("doc_id", "n_bytes", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == removed(rows) and sum(r.n_removed for r in got) > 2000


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_fingerprints(spark, kind):
    df, rows = frame(spark, kind)
    got = prints.report(df).collect()
    assert len(got) == len(rows)
    keyed = sorted(((k, t) for k, t in rows if k is not None), key=lambda r: (r[0] if kind == "bigint" else r[0].encode(), r[1].encode()))
    # null ids come first; their order is that of a hash, so it is read off the result
    nulls = [t for k, t in rows if k is None]
    edits = {hashlib.sha256((a[:len(a) - len(a) // 2] + b[:len(a) // 2]).encode()).hexdigest(): (a, b) for a in nulls for b in [*nulls, keyed[0][1]]}
    links = [edits[r.edited_sha256] for r in got if r.doc_id is None]
    assert sorted(a for a, _ in links) == sorted(nulls)
    want = []
    for (k, a), (_, b) in zip(keyed, keyed[1:]):
        want.append((k, len(a), hashlib.sha256((a[:len(a) - len(a) // 2] + b[:len(a) // 2]).encode()).hexdigest()))
    own = sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got if r.doc_id is not None)
    a = keyed[-1][1]
    ends = [(keyed[-1][0], len(a), hashlib.sha256((a[:len(a) - len(a) // 2] + b[:len(a) // 2]).encode()).hexdigest()) for b in nulls]
    assert any(own == sorted([*want, e]) for e in ends)
    by_text = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by_text.setdefault(r.n_chars, set()).add(r.fingerprint)
    assert len(by_text[len(A) + 2]) == 1
