"""Removal of byte strings of ``LENGTH`` bytes or more that start in more than one place.

Only suffixes that can have a long common prefix are sorted. A window of LENGTH bytes is filed under the least
hash of its ``GRAM``-byte strings, so equal windows always meet; neighbouring windows with the same least hash make one
segment. Segments whose file has no other entry, by far the most, are done. Equal segments (by their hash)
repeat as a whole. What is left is sorted within its file, one representative for each distinct segment: multikey
sorting, eight bytes a step, to a shallow depth, then a deep stage for the groups that still agree. The deep
stage compares what follows by prefix hashes instead of walking a blind trie (see README). Files with more than
``HOT`` segments are dealt by the hash of the windows themselves.

Null texts count as empty; texts under LENGTH bytes have no window and stay whole. Every row is a document of its
own, also with an equal id or text. An empty table gives no rows. Only key and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbwatch.llm.common import raw
from kerbwatch.session import materialise, ship_package

LENGTH, GRAM = 400, 200
SHALLOW = 32
HOT = 2_000
BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


class _Hash:
    """Hash of the ``size`` bytes at every place of a string, by differences of prefix sums."""

    def __init__(self):
        back = np.uint64(pow(int(_BASE), -1, 1 << 64))
        n = BLOCK + 2 * LENGTH
        self.power = np.cumprod(np.r_[np.uint64(1), np.full(n, _BASE)], dtype=np.uint64)
        self.back = np.cumprod(np.r_[np.uint64(1), np.full(n, back)], dtype=np.uint64)

    def of(self, data: bytes, size: int) -> np.ndarray:
        b = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
        b = (b ^ (b << np.uint64(21))) * _MIX
        total = np.r_[np.uint64(0), np.cumsum(b * self.power[:len(b)], dtype=np.uint64)]
        h = (total[size:] - total[:-size]) * self.back[:len(b) - size + 1]
        h = (h ^ (h >> np.uint64(32))) * _MIX
        return h ^ (h >> np.uint64(29))


def _least(h: np.ndarray, w: int) -> np.ndarray:
    """Least of each ``w`` neighbours."""
    span = 1
    while span * 2 <= w:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    return np.minimum(h[:len(h) - (w - span)], h[w - span:]) if w > span else h


def segments(text: bytes, hasher: _Hash) -> Iterator[tuple[int, int, int, bool]]:
    """(least hash, first window, last window, whether it is the least in two places) of runs filed together."""
    for at in range(0, max(0, len(text) - LENGTH + 1), BLOCK):
        part = text[at:at + BLOCK + LENGTH - 1]
        h, w = hasher.of(part, GRAM), LENGTH - GRAM + 1
        least = _least(h, w)
        edge = np.full(w - 1, np.uint64(0xFFFFFFFFFFFFFFFF))
        chosen, times = np.unique(h[~_least(np.r_[edge, ~least, edge], w) == h], return_counts=True)
        often = chosen[times > 1]
        cut = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        ends = np.r_[cut[1:], len(least)] - 1
        yield from zip(least[cut].view(np.int64).tolist(), (cut + at).tolist(), (ends + at).tolist(), np.isin(least[cut], often).tolist())


def occurrences(docs: DataFrame) -> DataFrame:
    """file, segment, key, text_hash, lo, hi, inner for every segment of every row of ``docs`` (key, text_hash, raw)."""
    kind = docs.schema["key"].dataType.simpleString()

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _Hash()
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                piece = batch.slice(start, 64)
                keys, hashes, texts = (c.to_pylist() for c in piece.columns)
                out: list[tuple] = []
                for k, th, text in zip(keys, hashes, texts):
                    view = memoryview(text)
                    out += [(f, xxhash.xxh3_64_intdigest(view[lo:hi + LENGTH]) - (1 << 63), k, th, lo, hi, own)
                            for f, lo, hi, own in segments(text, hasher)]
                if out:
                    cols = list(zip(*out))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], piece.schema.field(0).type),
                         pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int32()), pa.array(cols[5], pa.int32()), pa.array(cols[6])],
                        names=["file", "segment", "key", "text_hash", "lo", "hi", "inner"])

    return docs.select("key", "text_hash", "raw").mapInArrow(
        body, f"file bigint, segment bigint, key {kind}, text_hash bigint, lo int, hi int, inner boolean")


def repeated(parts: list[bytes], hasher: _Hash) -> list[tuple[int, int, int]]:
    """(number of the part, a, b): runs of bytes in ``parts`` covered by windows that start in two places.

    Multikey sorting of all windows' first ``SHALLOW`` bytes, eight at a time, dropping what is alone; then the
    groups that still agree are refined by the hash of their whole window.
    """
    which = np.concatenate([np.full(len(p) - LENGTH + 1, i) for i, p in enumerate(parts)])
    start = np.concatenate([np.arange(len(p) - LENGTH + 1) for p in parts])
    begins = np.cumsum([0, *map(len, parts)])[:-1]
    data = np.frombuffer(b"".join(parts) + bytes(8), np.uint8)
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    live, group = np.arange(len(start)), np.zeros(len(start), np.int64)

    def refined(live, group, value):
        order = np.lexsort((value, group))
        live, group, value = live[order], group[order], value[order]
        new = np.r_[True, (group[1:] != group[:-1]) | (value[1:] != value[:-1])]
        group = np.cumsum(new) - 1
        keep = np.bincount(group)[group] > 1
        return live[keep], group[keep]

    for depth in range(0, SHALLOW, 8):
        if len(live):
            place = begins[which[live]] + start[live] + depth
            live, group = refined(live, group, np.ascontiguousarray(words[place]).view(">u8").ravel())
    if not len(live):
        return []
    deep = np.zeros(len(start), np.uint64)
    first = np.r_[0, np.cumsum([len(p) - LENGTH + 1 for p in parts])]
    for i in np.unique(which[live]):
        deep[first[i]:first[i + 1]] = np.concatenate([hasher.of(parts[i][a:a + BLOCK + LENGTH - 1], LENGTH) for a in range(0, len(parts[i]) - LENGTH + 1, BLOCK)])
    live, group = refined(live, group, deep[live])
    live = np.sort(live)
    return _runs(which[live], start[live])


def _runs(which: np.ndarray, start: np.ndarray) -> list[tuple[int, int, int]]:
    """Sorted window starts to (part, a, b) byte runs."""
    if not len(start):
        return []
    cut = np.flatnonzero(np.r_[True, (which[1:] != which[:-1]) | (start[1:] > start[:-1] + LENGTH)])
    end = np.r_[cut[1:], len(start)] - 1
    return list(zip(which[cut].tolist(), start[cut].tolist(), (start[end] + LENGTH).tolist()))


def spans(docs: DataFrame) -> DataFrame:
    """key, text_hash and the byte runs (array of a, b) to remove, for rows (key, text_hash, raw) that have any."""
    found = materialise(occurrences(docs), "segments")
    many = F.min("segment") < F.max("segment")
    files = found.groupBy("file").agg(F.count("*").alias("n"), (many | F.max("inner")).alias("open"))
    # a segment with its least hash in two places may hold equal windows by itself
    files = files.where("n > 1 OR open").withColumnRenamed("file", "f")
    live = materialise(found.join(files, found.file == files.f).drop("f"), "segments-live")
    open_ = live.where("open")
    distinct = open_.groupBy("file", "segment").agg(
        F.count("*").alias("copies"), F.min(F.struct("key", "text_hash", "lo", "hi")).alias("at"))
    distinct = materialise(distinct, "segments-open")
    sizes = distinct.groupBy("file").agg(F.count("*").alias("segments"))
    wanted = distinct.join(sizes, "file").select("file", "segment", "segments", "at.*")
    wanted = wanted.groupBy("key", "text_hash").agg(F.collect_list(F.struct("file", "segment", "segments", "lo", "hi")).alias("wanted"))
    read = docs.join(wanted, ["key", "text_hash"])  # rows with equal key and text give equal bytes, which merge below
    read = read.select("raw", F.explode("wanted").alias("w"))
    text = materialise(read.select("w.file", "w.segment", "w.segments", F.substring("raw", F.col("w.lo") + 1, F.col("w.hi") - F.col("w.lo") + LENGTH)
                                   .alias("body")), "segment-bytes")

    def sort(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates(["file", "segment"]).sort_values("file")
        hasher, out = _Hash(), []
        for file, own in frame.groupby("file"):
            segment = own["segment"].tolist()
            out += [(file, segment[i], a, b) for i, a, b in repeated([bytes(x) for x in own["body"]], hasher)]
        return pd.DataFrame(out, columns=["file", "segment", "a", "b"])

    schema = "file bigint, segment bigint, a int, b int"
    packs = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))) * 4
    small = text.where(F.col("segments") <= HOT).groupBy(F.pmod(F.xxhash64("file"), F.lit(packs)).alias("pack")) \
        .applyInPandas(sort, schema)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, segment, body in zip(*(c.to_pylist() for c in batch.columns)):
                view = memoryview(body)
                for lo in range(0, len(body) - LENGTH + 1, 4096):
                    at = range(lo, min(len(body) - LENGTH + 1, lo + 4096))
                    digest = [xxhash.xxh3_128_digest(view[s:s + LENGTH]) for s in at]
                    n = len(digest)
                    yield pa.RecordBatch.from_arrays([pa.array([file] * n), pa.array([segment] * n), pa.array(list(at), pa.int32()),
                                                      pa.array(digest, pa.binary())], names=["file", "segment", "s", "h"])

    hot = text.where(F.col("segments") > HOT).dropDuplicates(["file", "segment"]).select("file", "segment", "body")
    each = hot.mapInArrow(windows, "file bigint, segment bigint, s int, h binary")
    twice = each.groupBy("h").count().where("count > 1").select("h")
    large = each.join(twice, "h").select("file", "segment", F.col("s").alias("a"), (F.col("s") + LENGTH).alias("b"))
    inner = materialise(small.unionByName(large).groupBy("file", "segment").agg(F.collect_list(F.struct("a", "b")).alias("runs")), "segment-runs")
    own = F.array(F.struct(F.lit(0).alias("a"), (F.col("hi") - F.col("lo") + LENGTH).alias("b")))
    closed = live.where("NOT open").withColumn("runs", own)
    facts = distinct.select("file", "segment", "copies").join(inner, ["file", "segment"], "left").where("copies > 1 OR runs IS NOT NULL")
    settled = open_.join(facts, ["file", "segment"]).withColumn("runs", F.when(F.col("copies") > 1, own).otherwise(F.col("runs")))
    both = closed.select("key", "text_hash", "lo", "runs").unionByName(settled.select("key", "text_hash", "lo", "runs"))
    moved = both.select("key", "text_hash", F.transform("runs", lambda r: F.struct((r["a"] + F.col("lo")).cast("int").alias("a"),
                                                                                     (r["b"] + F.col("lo")).cast("int").alias("b"))).alias("runs"))
    return moved.groupBy("key", "text_hash").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs``.

    Ids may be null, repeated or of any type: rows go by a hash of their id, which only deals them, and of their text.
    Null texts count as empty; rows that repeat are repeats of each other; an empty table gives no rows. Other columns
    are not read.
    """
    ship_package(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(key).alias("key"), F.coalesce(raw(text), F.lit(b"")).alias("raw"))
    rows = rows.withColumn("text_hash", F.xxhash64("raw"))
    joined = rows.join(spans(rows.drop("id")), ["key", "text_hash"], "left").select("id", "raw", "runs")

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                piece = batch.slice(lo, 256)
                out = []
                for value, runs in zip(piece.column(1).to_pylist(), piece.column(2).to_pylist()):
                    kept, at, removed, n = [], 0, 0, 0
                    last = -1
                    for a, b in sorted((r["a"], r["b"]) for r in runs or ()):
                        n += a > last
                        kept.append(value[at:max(a, at)])
                        removed += max(0, b - max(a, at))
                        at = last = max(at, b)
                    kept.append(value[at:])
                    out.append((len(value), removed, n, hashlib.sha256(b"".join(kept)).hexdigest()))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([piece.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3])],
                                                 names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.mapInArrow(body, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
