"""Spelling variants against brute force over all pairs of words, on odd rows; texts rewritten to their roots."""

import re
import zlib
from collections import Counter

import duckdb
import pytest

from kerbwatch.llm import queries, variants
from kerbwatch.session import materialise
from tests.conftest import SMALL

ROWS = [(1, None), (2, ""), (3, "kitten kitten kittens sitten mitten kiten kitte Kitten KITTEN 12 kitten"), (3, "kitten kittens sitten mitten kiten kitte"),
        (4, "sitten mitten kiten kitte kittens"), (None, "aaaaaa aaaaa aaaaaaa été! Étés étées étées-étées Étés÷x"), (5, "aaaaaa aaaaa aaaaaaa étées " * 400),
        (6, "xkitten\nkittenx kittnn\tkit$ten " * 3), (7, "aaaaaab aaaaab " * 5), (8, "mitten " * 11), (3, "kitten kittens sitten mitten kiten kitte")]


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows):
    n = Counter()
    for k, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    out, forms = {}, {}
    for w in n:
        others = sorted((-n[v], v) for v in n if near(w, v))
        form = others[0][1] if others and -others[0][0] >= 2 * n[w] else None
        forms[w] = form
        out[w] = (len(others), form, None if form is None else n[form])
    result = []
    for w in n:
        last = w
        while forms[last]:
            last = forms[last]
        result.append((w, out[w][1], last, n[w], out[w][0], out[w][2]))
    return sorted(result)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "a", 1, "b", "c") for k, t in ROWS]
    return materialise(spark.createDataFrame(rows, "doc_id bigint, text string, word string, n int, row string, value string").repartition(4), "odd")


def test_against_all_pairs(docs):
    want = plain(ROWS)
    assert len(want) > 10 and any(w[1] for w in want) and any(w[2] != w[0] and w[2] != w[1] for w in want + [("x", "y", "z")])
    assert sorted(map(tuple, variants.report(docs).collect())) == want
    assert variants.report(docs.where("false")).count() == 0


def test_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = con.sql(queries.SQL["op11_spelling_variants"])
    got = queries.QUERIES["op11_spelling_variants"](spark, SMALL)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_normalise(docs):
    forms = variants.report(docs)
    root = {r.word: r.root for r in forms.collect()}
    got = variants.normalise(docs, forms)
    assert got.columns == docs.columns

    def swap(m):
        word = re.sub("[A-Z]", lambda x: x.group().lower(), m.group())
        return m.group() if root.get(word, word) == word else root[word]

    want = sorted((str(k), str(t if t is None else re.sub("[A-Za-zÀ-ÿ]+", swap, t))) for k, t in ROWS)
    assert sorted((str(r.doc_id), str(r.text)) for r in got.collect()) == want != sorted((str(k), str(t)) for k, t in ROWS)
