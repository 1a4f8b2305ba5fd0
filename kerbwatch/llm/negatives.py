"""Hard negatives by segment summaries: bounds on inner products from means and deviations, refined by halves.

A vector is cut into ``SEGMENTS`` equal segments (padded with zeros), and each keeps its mean and its deviation. Over
one segment of length l the product of two vectors is l * (mean * mean' + c) with |c| <= deviation * deviation', so
the sums of ``mean * mean'`` plus or minus ``deviation * deviation'`` bound a score from both sides. Summaries
of one, two, four ... segments follow from the finest ones. A block of rows meets a block of anchors first by the
coarsest bounds; rows and anchors that no longer hold an open pair drop out, and only what all levels leave
open is scored exactly. A pair is closed when its score cannot lie in a wanted interval or cannot reach the last
place of what a task has found so far.

Anchors are the query set and meet all rows, in blocks: a pass sends a bounded number of anchors to the tasks, and
each task keeps the first places of each anchor, which one window puts in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbwatch.llm.common import materialise
from kerbwatch.session import ship_package

SEGMENTS = 16
#: Bytes of anchors that one pass sends to the tasks; rows and anchors of one block.
PASS_BYTES, ROWS, ANCHORS, FIRST_ROWS = 16 << 20, 2048, 1024, 256
#: Bytes of stored rows in one task, about.
TASK_BYTES = 32 << 20
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def summarise(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the segments of each row of ``v``; its width is a multiple of ``SEGMENTS``."""
    cut = v.reshape(len(v), SEGMENTS, -1).astype(np.float64)
    return cut.mean(axis=2), cut.std(axis=2)


def coarser(mean: np.ndarray, dev: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Summaries of neighbouring segments taken together."""
    m, d = mean.reshape(len(mean), -1, 2), dev.reshape(len(dev), -1, 2)
    half = (m[:, :, 0] - m[:, :, 1]) / 2
    return m.mean(axis=2), np.sqrt((d * d).mean(axis=2) + half * half)


class Vectors:
    """Integer vectors with their ids, labels and summaries of every level, coarsest first."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, mean: np.ndarray, dev: np.ndarray):
        self.ids, self.labels, self.v, self.levels = ids, labels, v, [(mean, dev)]
        while self.levels[0][0].shape[1] > 1:
            self.levels.insert(0, coarser(*self.levels[0]))
        mean, dev = self.levels[0]
        self.norm = np.sqrt(v.shape[1] * (mean * mean + dev * dev)).ravel()
        self.largest = max(abs(int(v.max())), abs(int(v.min()))) if v.size else 0

    def __getitem__(self, part) -> Vectors:
        out = Vectors.__new__(Vectors)
        out.ids, out.labels, out.v, out.norm = self.ids[part], self.labels[part], self.v[part], self.norm[part]
        out.levels, out.largest = [(m[part], d[part]) for m, d in self.levels], self.largest
        return out

    def __len__(self) -> int:
        return len(self.ids)


def scores(a: Vectors, b: Vectors, i: np.ndarray | None = None, j: np.ndarray | None = None) -> np.ndarray:
    """Exact products: all of a with b, or of the pairs (i, j). Beyond 64 bits they stay at the last integer."""
    big = a.largest * b.largest * a.v.shape[1] >= 1 << 53  # below, doubles hold every sum
    x, y = (w.v.astype(object if big else np.float64) for w in (a, b))
    out = x @ y.T if i is None else (x[i] * y[j]).sum(axis=1)
    return np.clip(out, LOWEST, HIGHEST).astype(np.int64) if big else out.astype(np.int64)


def open_pairs(a: Vectors, b: Vectors, low: np.ndarray, high: np.ndarray, fits: np.ndarray):
    """(i, j, score) of the pairs that ``fits`` allows and whose score is from low[i] to high[i]."""
    i, j, width = np.arange(len(a)), np.arange(len(b)), a.v.shape[1]
    low, high, mask = low.astype(np.float64), high.astype(np.float64), fits
    for level in range(len(a.levels)):
        keep_i, keep_j = mask.any(axis=1), mask.any(axis=0)
        if not (keep_i.all() and keep_j.all()):
            i, j, mask = i[keep_i], j[keep_j], mask[np.ix_(keep_i, keep_j)]
        if not len(i):
            break
        (ma, da), (mb, db) = a.levels[level], b.levels[level]
        length = width // ma.shape[1]
        middle, reach = length * (ma[i] @ mb[j].T), length * (da[i] @ db[j].T)
        reach += 1 + 1e-9 * np.outer(a.norm[i], b.norm[j])  # rounding
        mask = mask & (middle + reach >= low[i, None]) & (middle - reach <= high[i, None])
    p, q = np.nonzero(mask)
    if not len(p):
        return p, q, np.zeros(0, np.int64)
    if 8 * len(p) > mask.size:
        found = scores(a[i], b[j])[p, q]
    else:
        found = np.concatenate([scores(a[i], b[j], p[k:k + 65536], q[k:k + 65536]) for k in range(0, len(p), 65536)])
    return i[p], j[q], found


class Places:
    """The first ``k`` (score, id) of each wish: higher scores first, then smaller ids, within [low, high]."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        self.last = low.copy()
        self.wish, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, wish: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        good = (score >= self.last[wish]) & (score <= self.high[wish])
        if not good.any():
            return
        wish, score, ids = (np.concatenate([x, y[good]]) for x, y in ((self.wish, wish), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, ~score, wish))
        wish, score, ids = wish[order], score[order], ids[order]
        first = np.flatnonzero(np.r_[True, wish[1:] != wish[:-1]])
        rank = np.arange(len(wish)) - np.repeat(first, np.diff(np.r_[first, len(wish)]))
        kept = rank < self.k
        full = rank == self.k - 1
        self.last[wish[full]] = score[full]
        self.wish, self.score, self.id = wish[kept], score[kept], ids[kept]


class Search:
    """One block of anchors and the places of its wishes: ``wishes[i]`` lists those of anchor i, -1 for none."""

    def __init__(self, anchors: Vectors, wishes: np.ndarray, places: Places, same_label: bool):
        self.anchors, self.wishes, self.places, self.same = anchors, wishes, places, same_label

    def meet(self, rows: Vectors) -> None:
        some = self.wishes >= 0
        low = np.where(some, self.places.last[self.wishes], HIGHEST).min(axis=1)
        high = np.where(some, self.places.high[self.wishes], LOWEST).max(axis=1)
        fits = (self.anchors.labels[:, None] == rows.labels) == self.same
        fits &= self.anchors.ids[:, None] != rows.ids
        fits &= some.any(axis=1)[:, None]
        i, j, score = open_pairs(self.anchors, rows, low, high, fits)
        for column in self.wishes.T:
            wish = column[i]
            has = wish >= 0
            self.places.add(wish[has], score[has], rows.ids[j[has]])


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    """Lists as the rows of a matrix; shorter ones end in zeros."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
    sizes = np.diff(offsets)
    if (sizes == width).all():
        return values.reshape(len(sizes), width).astype(kind)
    out = np.zeros((len(sizes), width), kind)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values
    return out


def _vectors(batch: pa.RecordBatch | pa.Table, width: int) -> Vectors:
    get = lambda name: batch.column(name).combine_chunks() if isinstance(batch, pa.Table) else batch.column(name)
    summary = _matrix(get("summary"), 2 * SEGMENTS, np.float64)
    return Vectors(get("id").to_numpy(zero_copy_only=False), get("label").to_numpy(zero_copy_only=False),
                   _matrix(get("v"), width, np.int64), summary[:, :SEGMENTS], summary[:, SEGMENTS:])


_STORED = "id bigint, label bigint, v array<bigint>, summary array<double>"


def stored(vectors: DataFrame) -> tuple[DataFrame, int]:
    """The table that is searched (id, label, v, summary), written once, and the padded width of its vectors.

    ``vectors`` has id, label and v (integers). Rows with a null in any of them, or a null component, take no part. An
    id names one row: of repeated ones the least label and vector is taken. Vectors may differ in length: missing
    components count as zero.
    """
    ship_package(vectors.sparkSession)
    rows = vectors.select(F.col("id").cast("bigint"), F.col("label").cast("bigint"), F.col("v").cast("array<bigint>"))
    rows = rows.dropna().where(~F.exists("v", lambda x: x.isNull()))
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("row")).select("id", "row.*")
    rows = materialise(rows, "vectors")
    n, longest = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    width = max(1, -(-(longest or 0) // SEGMENTS)) * SEGMENTS

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mean, dev = summarise(_matrix(batch.column(2), width, np.int64))
            flat = np.concatenate([mean, dev], axis=1)
            offsets = np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]
            summary = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, summary], names=["id", "label", "v", "summary"])

    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n * width * 8 // TASK_BYTES))
    return materialise(rows.repartition(parts, "id").mapInArrow(body, _STORED), "segment-summaries"), width


def _search(table: DataFrame, anchors: DataFrame, width: int, k: int, same_label: bool, schema: str,
            wishes_of, out_of) -> DataFrame:
    """All rows of ``table`` meet all ``anchors``, pass by pass; the places that the tasks found, one row each."""
    spark = table.sparkSession
    per_pass = max(1, PASS_BYTES // (width * 8))
    n, passes = anchors.count(), 1
    while True:  # passes of a proven size
        chunk = F.pmod(F.xxhash64("id"), F.lit(passes))
        most = anchors.groupBy(chunk.alias("c")).count().agg(F.max("count")).first()[0] if n > per_pass else n
        if (most or 0) <= per_pass:
            break
        passes = max(passes + 1, -(-5 * n // (4 * per_pass)))
    out = None
    for number in range(passes):
        sent = spark.sparkContext.broadcast(anchors.where(chunk == number).toArrow())

        def body(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            whole = sent.value
            searches = []
            for lo in range(0, whole.num_rows, ANCHORS):
                piece = whole.slice(lo, ANCHORS)
                searches.append((piece, Search(_vectors(piece, width), *wishes_of(piece, k), same_label)))
            met = False
            for batch in batches:
                rows = _vectors(batch, width)
                cuts = [0, FIRST_ROWS] if not met else [0]
                cuts += range(cuts[-1] + ROWS, len(rows), ROWS)
                met = True
                for lo, hi in zip(cuts, [*cuts[1:], len(rows)]):
                    part = rows[lo:hi]
                    for _, search in searches if len(part) else ():
                        search.meet(part)
            for piece, search in searches:
                yield out_of(piece, search)

        found = materialise(table.mapInArrow(body, schema), "places")
        out = found if out is None else out.union(found)
    return out


def positives(table: DataFrame, anchors: DataFrame, width: int, k: int) -> DataFrame:
    """anchor, positive and score of each anchor's first ``k`` other rows of its label."""
    def wishes_of(piece: pa.Table, k: int):
        n = piece.num_rows
        return np.arange(n)[:, None], Places(np.full(n, LOWEST), np.full(n, HIGHEST), k)

    def out_of(piece: pa.Table, search: Search) -> pa.RecordBatch:
        p = search.places
        return pa.RecordBatch.from_arrays([pa.array(search.anchors.ids[p.wish]), pa.array(p.id), pa.array(p.score)],
                                          names=["anchor", "positive", "score"])

    found = _search(table, anchors, width, k, True, "anchor bigint, positive bigint, score bigint", wishes_of, out_of)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "positive")
    return materialise(found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).drop("r"), "positives")


def share_of(score: np.ndarray, part: tuple[int, int], up: bool) -> np.ndarray:
    """``score * part`` in whole numbers, rounded up or down, without leaving 64 bits."""
    top, bottom = part
    whole, rest = np.divmod(score, bottom)
    return whole * top + (-(-rest * top // bottom) if up else rest * top // bottom)


def mine(vectors: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 10,
         low: tuple[int, int] = (3, 10), high: tuple[int, int] = (9, 10)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``vectors`` has id, label and v (see ``stored``); ``is_anchor`` is a condition on id or label. Scores are integer
    products with the anchor; higher ones come first, ties by smaller id. For each of an anchor's first
    ``n_positives`` other rows of its label, the first ``n_negatives`` rows of other labels with a score from ``low``
    to ``high`` times the positive's (fractions of at most 1). An anchor without a positive, and a positive without a negative, has no row;
    an empty table gives none. Only these three columns are read, so others' names cannot clash.
    """
    table, width = stored(vectors)
    anchors = table.where(is_anchor)
    near = positives(table, anchors, width, n_positives)
    wished = near.groupBy("anchor").agg(F.collect_list(F.struct("positive", "score")).alias("wanted"))  # at most n_positives
    asked = materialise(anchors.join(wished, anchors.id == wished.anchor).select(
        "id", "label", "v", "summary", F.col("wanted.positive").alias("positive"), F.col("wanted.score").alias("score")), "asked")

    def wishes_of(piece: pa.Table, k: int):
        score = piece.column("score").combine_chunks()
        sizes = np.diff(score.offsets.to_numpy())
        flat = score.flatten().to_numpy(zero_copy_only=False)
        wishes = np.full((len(sizes), int(sizes.max(initial=1))), -1)
        row = np.repeat(np.arange(len(sizes)), sizes)
        wishes[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.arange(len(flat))
        return wishes, Places(share_of(flat, low, True), share_of(flat, high, False), k)

    def out_of(piece: pa.Table, search: Search) -> pa.RecordBatch:
        sizes = np.diff(piece.column("score").combine_chunks().offsets.to_numpy())
        flat = [piece.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("positive", "score")]
        p = search.places
        columns = [np.repeat(search.anchors.ids, sizes)[p.wish], flat[0][p.wish], p.id, flat[1][p.wish], p.score]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns],
                                          names=["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    found = _search(table, asked, width, n_negatives, False, "anchor_id bigint, positive_id bigint, negative_id bigint, "
                    "positive_score bigint, negative_score bigint", wishes_of, out_of)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
