"""Spelling variants: words one edit apart meet in a permuterm index, and each word points to its commoner form.

A word is marked with a terminator and rotated. The rotation that ends in letter i, without that letter, is a prefix
that all words share that differ in letter i alone; the rotation of the shorter word is that prefix itself. So the
rotations, whole and without their last letter, are sorted, and a scan over equal ones sees replacements as the
members that skipped a letter, and the indel as the one member that skipped none. A group has at most one member
for each letter of the alphabet, whatever the corpus holds. Every member leaves with how many others it has met and
the commonest of them; no pair is written.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbwatch.llm.common import materialise
from kerbwatch.session import ship_package

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END = "$"
#: One run in so many loses a letter; length and count that make a word.
LOSS, MIN_LETTERS, MIN_COUNT = 97, 5, 3


def _damaged(key: Column, run: Column) -> Column:
    """The run, without one letter where its checksum with the key is divisible by ``LOSS``."""
    h = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % LOSS == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", min_letters: int = MIN_LETTERS,
               min_count: int = MIN_COUNT) -> DataFrame:
    """word and n: every word of all texts and how often it occurs, counted before the shuffle."""
    runs = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(f"({RUN})"), 1)
    rows = docs.select(F.col(key).alias("key"), F.explode(runs).alias("run"))
    words = rows.select(_damaged(F.col("key"), F.col("run")).alias("word")).where(F.length("word") >= min_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """Two rows for each rotation: whole (``skipped`` false) and without its last letter.

    ``opens`` marks the first letter of a run of equal ones: leaving out any of them gives the same shorter word, so
    only that one counts as an indel.
    """
    k = F.col("k")

    def letter(i: Column) -> Column:
        return F.substring("word", i, 1)

    rows = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("k"))
    tail, before = F.substring(F.col("word"), k + 1, F.length("word")), F.substring(F.col("word"), F.lit(1), k)
    shorter = F.substring(F.col("word"), F.lit(1), k - 1)
    whole = F.struct(F.concat(tail, F.lit(END), before).alias("key"), F.lit(False).alias("skipped"), F.lit(True).alias("opens"))
    less = F.struct(F.concat(tail, F.lit(END), shorter).alias("key"), F.lit(True).alias("skipped"),
                    ((k == 1) | (letter(k) != letter(k - 1))).alias("opens"))
    both = F.array_compact(F.array(whole, F.when(k > 0, less)))
    return rows.select("word", "n", F.explode(both).alias("r")).select("r.key", "r.skipped", "r.opens", "word", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """word, n_near, near and near_n for every word that has near ones: how many, and the commonest (ties: the least)."""
    ship_package(words.sparkSession)
    schema = pa.schema([("word", pa.string()), ("met", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])

    def members(rows: list[tuple]) -> Iterator[tuple]:
        # sorted: the whole rotation first, then the commonest
        shorter = [r for r in rows if not r[1]]
        longer = [r for r in rows if r[1]]
        opening = [r for r in longer if r[2]]
        for r in longer:
            others = [longer[1] if r is longer[0] else longer[0]] if len(longer) > 1 else []
            others += shorter if r[2] else []
            if others:
                best = min(others, key=lambda o: (-o[4], o[3]))
                yield r[3], len(longer) - 1 + (len(shorter) if r[2] else 0), best[3], best[4]
        for r in shorter:
            if opening:
                yield r[3], len(opening), opening[0][3], opening[0][4]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        out: list[tuple] = []
        for _, group in groupby(rows(), key=lambda r: r[0]):
            group = list(group)  # at most one for each letter
            if len(group) > 1:
                out += members(group)
            if len(out) >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    ordered = rotations(words).repartitionByRange("key").sortWithinPartitions("key", "skipped", F.desc("n"), "word")
    met = ordered.select("key", "skipped", "opens", "word", "n").mapInArrow(scan, "word string, met bigint, near string, near_n bigint")
    least = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    return met.groupBy("word").agg(F.sum("met").alias("n_near"), least).select(
        "word", "n_near", "best.near", (-F.col("best.less")).alias("near_n"))


def roots(links: DataFrame) -> DataFrame:
    """word and root: the last word reached from ``word`` over ``form``, by pointer doubling.

    A form is at least twice as common as its word, so paths are short and never closed.
    """
    links = materialise(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = links.join(ahead, "root")
        if not longer.take(1):
            return links
        longer = links.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        links = materialise(longer, "forms")


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", min_letters: int = MIN_LETTERS,
           min_count: int = MIN_COUNT) -> DataFrame:
    """word, n, n_near, form, form_n and root for every word of all texts.

    Null and empty texts have no words; a null key counts as an empty one; rows that repeat count as often as they
    occur. Without words there are no rows. Only key and text are read, so other columns' names cannot clash.
    """
    words = materialise(vocabulary(docs, key, text, min_letters, min_count), "words")
    found = words.join(materialise(neighbours(words), "near-words"), "word", "left")
    common = F.col("near_n") >= 2 * F.col("n")
    found = materialise(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(common, F.col("near")).alias("form"),
                                     F.when(common, F.col("near_n")).alias("form_n")), "word-forms")
    ends = roots(found.where("form IS NOT NULL"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def normalise(docs: DataFrame, forms: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every word that ``forms`` gives another root replaced by it (in lower case); all else stays.

    Words are looked up by a join, each row's distinct ones once; rows keep their columns and nulls.
    """
    other = forms.where("root <> word").select("word", "root")
    rows = materialise(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at"),
                                   F.col(text).alias("value")), "rows")
    runs = F.array_distinct(F.regexp_extract_all(F.translate("value", UPPER, LOWER), F.lit(f"({RUN})"), 1))
    used = rows.select("at", F.explode(runs).alias("word")).join(other, "word")
    swaps = used.groupBy("at").agg(F.map_from_entries(F.collect_list(F.struct("word", "root"))).alias("swaps"))
    gap = F.lit(rf"([^A-Za-zÀ-ÿ]*)({RUN}|\z)")
    pieces = F.arrays_zip(F.regexp_extract_all("value", gap, 1).alias("gap"), F.regexp_extract_all("value", gap, 2).alias("run"))
    swapped = F.transform(pieces, lambda p: F.concat(p["gap"], F.coalesce(F.element_at("swaps", F.translate(p["run"], UPPER, LOWER)), p["run"])))
    joined = rows.join(swaps, "at", "left").withColumn("new", F.when(F.col("swaps").isNull(), F.col("value")).otherwise(F.array_join(swapped, "")))
    return joined.select(*(F.col("new").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns))
