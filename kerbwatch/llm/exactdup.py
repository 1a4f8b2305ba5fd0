"""Exact duplicates: counting quotient filters find the fingerprints that occur more than once, bytes decide.

A text's fingerprint is its XXH64. The leading bits name a shard, the next ``BITS`` are split into quotient and
remainder. Every task files its fingerprints in one filter for each shard: a run of sorted remainders for each
quotient, in slots found by linear probing, with an ``occupied`` bit per quotient, a ``run end`` bit per slot, and
further slots holding the digits of counts above one. Filters give back their fingerprints and counts without
loss, so those of a shard are merged by their sorted remainders. Fingerprints counted once are unique texts and
never meet a shuffle; all others, by way of a bitmap of bounded size, send their rows to the comparison of whole texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbwatch.llm.common import look_up, materialise, raw
from kerbwatch.session import ship_package

#: Bits of a fingerprint behind its shard, split into quotient and remainder.
BITS = 40
#: Fingerprints of a shard and fingerprints that a task holds before it writes filters, about.
SHARD, HELD = 1 << 18, 1 << 21
#: Most leading bits by which rows are sent to the byte comparison: a bitmap of 2 ** 28 bits is 32 MB.
ROUTE = 28
_PAGE = 15


class Filter:
    """A counting quotient filter over distinct sorted fingerprints of ``BITS`` bits, with counts."""

    @staticmethod
    def pack(fp: np.ndarray, count: np.ndarray) -> bytes:
        q = max(0, int(np.ceil(np.log2(max(1, len(fp)) * 4 / 3))))
        r = BITS - q
        width = -(-r // 8)
        quotient, remainder = (fp >> np.uint64(r)).astype(np.int64), fp & np.uint64((1 << r) - 1)
        more = (count - 1).astype(np.uint64)
        digits, left = np.zeros(len(fp), np.int64), more.copy()
        while (open_ := left > 0).any():
            digits += open_
            left >>= np.uint64(8 * width)
        size = 1 + digits
        first = np.flatnonzero(np.r_[True, quotient[1:] != quotient[:-1]]) if len(fp) else np.zeros(0, np.int64)
        runs = np.add.reduceat(size, first) if len(fp) else np.zeros(0, np.int64)
        before = np.cumsum(runs) - runs
        starts = before + np.maximum.accumulate(quotient[first] - before) if len(fp) else runs
        ends = starts + runs - 1
        slots = max(1 << q, int(ends[-1]) + 1) if len(fp) else 1 << q
        occupied, run_end, digit = np.zeros(1 << q, bool), np.zeros(slots, bool), np.zeros(slots, bool)
        occupied[quotient[first]], run_end[ends] = True, True
        value = np.zeros(slots, np.uint64)
        run = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(fp)]))
        at = starts[run] + (np.cumsum(size) - size) - before[run] if len(fp) else runs
        value[at] = remainder
        for k in range(int(digits.max()) if len(fp) else 0):
            some = digits > k
            digit[at[some] + 1 + k] = True
            value[at[some] + 1 + k] = (more[some] >> np.uint64(8 * width * k)) & np.uint64((1 << (8 * width)) - 1)
        body = value.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        head = np.array([q, slots], "<i8").tobytes()
        return head + b"".join(x.tobytes() for x in (np.packbits(occupied), np.packbits(run_end), np.packbits(digit), body))

    @staticmethod
    def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Sorted fingerprints and their counts."""
        q, slots = (int(x) for x in np.frombuffer(data, "<i8", 2))
        r = BITS - q
        width, at = -(-r // 8), 16

        def bits(n: int) -> np.ndarray:
            nonlocal at
            piece = np.frombuffer(data, np.uint8, -(-n // 8), at)
            at += len(piece)
            return np.unpackbits(piece, count=n).astype(bool)

        occupied, run_end, digit = bits(1 << q), bits(slots), bits(slots)
        value = np.zeros((slots, 8), np.uint8)
        value[:, :width] = np.frombuffer(data, np.uint8, slots * width, at).reshape(slots, width)
        value = value.view("<u8").ravel()
        quotient, ends = np.flatnonzero(occupied), np.flatnonzero(run_end)
        starts = np.maximum(quotient, np.r_[-1, ends[:-1]][:len(ends)] + 1)
        length = ends - starts + 1
        used = np.repeat(starts - (np.cumsum(length) - length), length) + np.arange(length.sum())
        is_digit, value = digit[used], value[used]
        entry = np.cumsum(~is_digit) - 1
        head = np.flatnonzero(~is_digit)
        fp = (np.repeat(quotient, length)[head].astype(np.uint64) << np.uint64(r)) | value[head]
        count = np.ones(len(head), np.int64)
        place = (np.arange(len(used)) - head[entry] - 1)[is_digit]
        np.add.at(count, entry[is_digit], (value[is_digit] << (place * 8 * width).astype(np.uint64)).astype(np.int64))
        return fp, count


def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted fingerprints of several filters as one, counts added."""
    fp, count = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(fp, kind="stable")  # merges the sorted runs
    fp, count = fp[order], count[order]
    first = np.flatnonzero(np.r_[True, fp[1:] != fp[:-1]]) if len(fp) else np.zeros(0, np.int64)
    return fp[first], np.add.reduceat(count, first) if len(fp) else count


def filters(prints: DataFrame, shard_bits: int) -> DataFrame:
    """shard and filter of every task's fingerprints ``h`` (signed 64 bits)."""
    ship_package(prints.sparkSession)

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def take() -> Iterator[pa.RecordBatch]:
            h = np.concatenate(held)
            held.clear()
            top, count = np.unique(h >> np.uint64(64 - shard_bits - BITS), return_counts=True)
            shard = (top >> np.uint64(BITS)).astype(np.int64)
            cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
            local = top & np.uint64((1 << BITS) - 1)
            for lo in range(0, len(cuts), 4096):
                part = [slice(a, b) for a, b in zip(cuts[lo:lo + 4096], np.r_[cuts, len(top)][lo + 1:lo + 4097])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(shard[p.start]) for p in part], pa.int64()),
                     pa.array([Filter.pack(local[p], count[p]) for p in part], pa.binary())], names=["shard", "filter"])

        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            if sum(map(len, held)) >= HELD:
                yield from take()
        if sum(map(len, held)):
            yield from take()

    return prints.select("h").mapInArrow(body, "shard bigint, filter binary")


def merged(parts: DataFrame) -> DataFrame:
    """One filter for each shard."""
    def add(frame: pd.DataFrame) -> pd.DataFrame:
        whole = Filter.pack(*merge([Filter.unpack(x) for x in frame["filter"]]))
        return pd.DataFrame({"shard": frame["shard"][:1], "filter": [whole]})

    return parts.groupBy("shard").applyInPandas(add, "shard bigint, filter binary")


def repeated(whole: DataFrame, shard_bits: int) -> DataFrame:
    """``top``, the leading bits of every fingerprint that a merged filter counts more than once, and ``n``."""
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fp, count = Filter.unpack(data)
                often = count > 1
                top = (fp[often].astype(np.int64)) | (shard << BITS)
                yield pa.RecordBatch.from_arrays([pa.array(top), pa.array(count[often])], names=["top", "n"])

    return whole.select("shard", "filter").mapInArrow(body, "top bigint, n bigint")


def _place(top: Column, bits: int, route: int) -> tuple[Column, Column]:
    """Page and bit in a bitmap over ``route`` bits of a fingerprint whose leading ``bits`` are given."""
    place = F.shiftrightunsigned(top, bits - route)
    return F.shiftright(place, _PAGE).alias("page"), place.bitwiseAND((1 << _PAGE) - 1).alias("bit")


def _routed(rows: DataFrame, bitmap: DataFrame, route: int) -> DataFrame:
    """``rows`` with ``often``: whether the bitmap has their fingerprint ``h``. It has 2 ** (ROUTE - 15) pages at most."""
    page, bit = _place(F.col("h"), 64, route)
    rows = rows.select("*", page, bit).join(F.broadcast(bitmap), "page", "left")
    byte = F.conv(F.hex(F.expr("substring(bits, bit div 8 + 1, 1)")), 16, 10).cast("bigint")
    return rows.withColumn("often", F.coalesce(F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1, F.lit(False))) \
        .drop("page", "bit", "bits")


def fingerprint(value: Column) -> Column:
    return F.xxhash64(value)


def report(docs: DataFrame, key: str = "doc_id", text: str = "text",
           normalise: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """``key``, keep_id, group_size, kept and text_sha256 for every row of ``docs``.

    Texts are equal when their normalised bytes are; null counts as empty. Of equal texts the row with the largest key
    stays, null keys last; of repeated rows with that key exactly one. keep_id is null where all keys of a group are
    null. An empty table gives no rows; other columns are neither read nor returned, so their names cannot clash.
    """
    value = F.coalesce(raw(normalise(F.col(text))), F.lit(b""))
    texts = docs.select(F.col(key).alias("key"), value.alias("value"))
    slim = materialise(texts.select("key", fingerprint(F.col("value")).alias("h"), F.sha2("value", 256).alias("sha"),
                                    F.monotonically_increasing_id().alias("row")), "text-prints")
    total = slim.count()
    shard_bits = max(0, -(-total // SHARD) - 1).bit_length()
    whole = materialise(merged(filters(slim, shard_bits)), "quotient-filters")
    route = min(ROUTE, max(_PAGE, total.bit_length() + 2))  # a row in eight, or fewer, is sent without need
    page, bit = _place(F.col("top"), shard_bits + BITS, route)
    bitmap = repeated(whole, shard_bits).select(page, bit).groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits"))
    bitmap = materialise(bitmap, "repeated-prints")

    sent = _routed(texts.withColumn("h", fingerprint(F.col("value"))), bitmap, route).where("often")
    # the byte comparison: one group for each whole text, combined before the shuffle
    same = sent.groupBy("h", "value").agg(F.count("*").alias("n"))
    same = same.select("h", F.sha2("value", 256).alias("sha"), "n").groupBy("h", "sha").agg(F.max("n").alias("bytes_n"))
    rows = materialise(_routed(slim, bitmap, route), "routed-prints")
    best = F.struct(F.col("key").isNotNull().alias("own"), "key", (-F.col("row")).alias("row"))
    groups = rows.where("often").groupBy("h", "sha").agg(F.count("*").alias("n"), F.max(best).alias("best"))
    # rows meet their group by SHA-256; should two texts ever share it, their byte groups are smaller than it
    agreed = F.when(F.col("bytes_n") == F.col("n"), F.col("n")).otherwise(
        F.raise_error(F.lit("different texts share a SHA-256")).cast("bigint"))
    groups = groups.join(same, ["h", "sha"]).select("h", "sha", agreed.alias("n"), "best")
    groups = materialise(groups, "equal-texts")
    found = look_up(rows.where("often"), groups, ["h", "sha"], "n", total).select(
        "key", F.col("best.key").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == -F.col("best.row")).alias("kept"), "sha")
    alone = rows.where("NOT often").select("key", F.col("key").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
                                           F.lit(True).alias("kept"), "sha")
    return found.unionByName(alone).select(F.col("key").alias(key), "keep_id", "group_size", "kept",
                                           F.col("sha").alias("text_sha256"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text",
                normalise: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of repeated rows with the same key any one."""
    value = F.coalesce(raw(normalise(F.col(text))), F.lit(b""))
    gone = report(docs, key, text, normalise).where("NOT kept").select(F.col(key).alias("key"), F.col("text_sha256").alias("sha"),
                                                                       F.col("keep_id").alias("best"))
    gone = materialise(gone.distinct(), "dropped-rows")
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("key"), F.sha2(value, 256).alias("sha"))
    last = gone.where(F.col("key").eqNullSafe(F.col("best")))
    same = [F.col("sha") == F.col("s"), F.col("key").eqNullSafe(F.col("k"))]

    def named(df: DataFrame) -> DataFrame:
        return df.select(F.col("key").alias("k"), F.col("sha").alias("s"))

    single = rows.join(named(gone), same, "left_anti")
    tied = rows.join(named(last), same, "left_semi").groupBy("key", "sha").agg(F.first("row").alias("row"))
    return single.select("row.*").unionByName(tied.select("row.*"))
