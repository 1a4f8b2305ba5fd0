"""SimHash fingerprints and their near-duplicate groups.

Fingerprints that differ in at most ``budget`` bits are linked. The self-join walks a binary trie against
itself: pairs of nodes go down together, the bits in which they differ are added up, and a pair that
exceeds the budget is cut off with everything below it.

To deal the trie over tasks, the 64 bits are cut into ``budget + 1`` blocks. Two fingerprints within the
budget agree in at least one block, so each block in turn is rotated to the top, and only fingerprints with
the same top bits share a subtree. A pair is reported at the first block in which it agrees. Subtrees with
more than ``HOT`` fingerprints are dealt again as pairs of salts. A task reports a spanning forest of the
links it found, never all pairs, and stops walking node pairs whose fingerprints are joined already.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbwatch.llm.common import map_rows, raw
from kerbwatch.llm.components import components
from kerbwatch.session import materialise, ship_package

SEED = 42
#: Fingerprints of one subtree that one task takes whole.
HOT = 20_000
#: Fingerprints that are dealt to one task, about.
PACK = 30_000
#: Node pairs that are walked at a time.
FRONT = 400_000


def fingerprint(text: bytes | None, width: int) -> int:
    """Signed 64-bit SimHash of a text's word shingles: majority of the bits of their XXH64; 0 without words."""
    words = text.lower().split() if text else []  # bytes: A-Z only, and exactly the ASCII white space
    if not words:
        return 0
    if len(words) < width:
        return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(words), SEED)).view(np.int64))
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    n, digest = len(words) - width + 1, xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, 1 << 16):
        hi = min(n, lo + (1 << 16))
        h = np.fromiter((digest(line[a:b - 1], SEED) for a, b in zip(starts[lo:hi], ends[lo + width - 1:hi + width - 1])),
                        np.uint64, hi - lo)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 4) -> DataFrame:
    """``key`` and ``fp`` (signed 64 bits) for every row of ``docs``; a null text has no words."""
    kind = docs.schema[key].dataType.simpleString()

    def make():
        return lambda k, t: (k, fingerprint(t, width))

    return map_rows(docs.select(F.col(key).alias("key"), raw(text).alias("text")), make, f"key {kind}, fp bigint") \
        .withColumnRenamed("key", key)


class Trie:
    """Path-compressed binary trie over values sorted within groups; every group is a tree of its own."""

    def __init__(self, values: np.ndarray, group: np.ndarray):
        cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        lo, hi = cuts, np.r_[cuts[1:], len(values)]
        self.roots = np.arange(len(lo))
        first, bit, left, right, levels, n = [], [], [], [], [], 0
        while len(lo):
            x = values[lo] ^ values[hi - 1]
            leaf = x == 0
            b = np.where(leaf, -1, np.frexp(np.maximum(x >> np.uint64(1), np.uint64(0)).astype(np.float64))[1])
            # frexp of the half can round up: step back where the bit is not set
            b = np.where(~leaf & ((x >> np.maximum(b, 0).astype(np.uint64)) == 0), b - 1, b)
            levels.append((n, n + len(lo)))
            first.append(values[lo])
            bit.append(b)
            inner = np.flatnonzero(~leaf)
            at = np.full(len(lo), -1)
            at[inner] = n + len(lo) + 2 * np.arange(len(inner))
            left.append(at)
            right.append(np.where(at < 0, -1, at + 1))
            n += len(lo)
            l, h, s = lo[inner], hi[inner], b[inner].astype(np.uint64)
            wanted = ((values[l] >> s) | np.uint64(1)) << s
            mid = self._split(values, l, h, wanted)
            lo = np.stack([l, mid], 1).ravel()
            hi = np.stack([mid, h], 1).ravel()
        self.first, self.bit = np.concatenate(first), np.concatenate(bit).astype(np.int16)
        self.left, self.right, self.levels = np.concatenate(left), np.concatenate(right), levels

    @staticmethod
    def _split(values, lo, hi, wanted):
        """First place in [lo, hi) whose value is at least the wanted one."""
        lo, hi = lo.copy(), hi.copy()
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            below = open_ & (values[np.minimum(mid, len(values) - 1)] < wanted)
            lo, hi = np.where(below, mid + 1, lo), np.where(open_ & ~below, mid, hi)
        return lo

    def uniform(self, label: np.ndarray) -> np.ndarray:
        """For each node the label that all its leaves have, or -1."""
        out = label.copy()
        for a, b in reversed(self.levels):
            inner = a + np.flatnonzero(self.left[a:b] >= 0)
            x, y = out[self.left[inner]], out[self.right[inner]]
            out[inner] = np.where(x == y, x, -1)
        return out


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of a[i] and b[i] in ``label`` (in place); a class is named by its smallest member."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (step := label[label])[label != step].size:
            label[:] = step


def trie_links(values: np.ndarray, group: np.ndarray, side: np.ndarray | None, budget: int, earlier: list[np.ndarray]):
    """(i, root of i) for values that are linked, as node numbers' first values.

    ``values`` are sorted within ``group`` and distinct there. ``earlier`` holds masks, per value, of blocks in
    which a pair must differ (an agreement there is reported by another task).
    """
    t = Trie(values, group)
    leaf = np.flatnonzero(t.bit < 0)
    place = np.full(len(t.bit), -1)
    # leaves in order of their values within groups: the k-th row is the leaf whose first value it is
    order = np.lexsort((t.first[leaf], _leaf_group(t, leaf)))
    place[leaf[order]] = np.arange(len(leaf))
    label = np.arange(len(t.bit))
    stack, same = [(t.roots, t.roots)], t.uniform(label)
    while stack:
        a, b = stack.pop()
        if len(a) > FRONT:
            stack += [(a[k:k + FRONT], b[k:k + FRONT]) for k in range(0, len(a), FRONT)]
            continue
        keep = ~((same[a] == same[b]) & (same[a] >= 0))
        a, b = a[keep], b[keep]
        own = a == b
        la, ra = t.left[a[own]], t.right[a[own]]
        p, q = [la, ra, la], [la, ra, ra]
        a, b = a[~own], b[~own]
        first = t.bit[a] >= t.bit[b]
        x, y = a[first], b[first]
        p += [t.left[x], t.right[x]]
        q += [y, y]
        x, y = a[~first], b[~first]
        p += [x, x]
        q += [t.left[y], t.right[y]]
        a, b = np.concatenate(p), np.concatenate(q)
        below = np.maximum(t.bit[a], t.bit[b]).astype(np.int64) + 1
        diff = t.first[a] ^ t.first[b]
        high = np.where(below > 63, np.uint64(0), diff >> np.minimum(below, 63).astype(np.uint64))
        near = (np.bitwise_count(high) <= budget) | (a == b)
        a, b, below, diff = a[near], b[near], below[near], diff[near]
        done = (below == 0) & (a != b)
        if done.any():
            x, y = a[done], b[done]
            i, j = place[x], place[y]
            good = np.ones(len(x), bool)
            for mask in earlier:
                good &= (diff[done] & mask[i]) != 0
            if side is not None:
                good &= side[i] != side[j]
            if good.any():
                merge(label, x[good], y[good])
                same = t.uniform(label)
        if (~done).any():
            stack.append((a[~done], b[~done]))
    moved = leaf[label[leaf] != leaf]
    return place[moved], place[label[moved]]


def _leaf_group(t: Trie, leaf: np.ndarray) -> np.ndarray:
    """Number of the tree that each leaf belongs to."""
    tree = np.full(len(t.bit), -1)
    tree[t.roots] = t.roots
    for a, b in t.levels:
        inner = a + np.flatnonzero(t.left[a:b] >= 0)
        tree[t.left[inner]] = tree[inner]
        tree[t.right[inner]] = tree[inner]
    return tree[leaf]


def blocks(budget: int) -> list[tuple[int, int]]:
    """(offset from the top, width) of ``budget + 1`` blocks of near equal width."""
    n = budget + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _rotate(v: np.ndarray, by: int) -> np.ndarray:
    return v if by == 0 else (v << np.uint64(by)) | (v >> np.uint64(64 - by))


def links(fps: DataFrame, budget: int = 4) -> DataFrame:
    """a, b: a spanning forest of the links between distinct fingerprints ``fp`` (signed 64 bits)."""
    ship_package(fps.sparkSession)
    parts = blocks(budget)
    n = fps.count()
    packs = max(1, min(4096, -(-n // PACK)))
    top = [F.shiftrightunsigned(F.shiftleft("fp", off) if off else F.col("fp"), 64 - width).alias("value")
           for off, width in parts]
    dealt = fps.select("fp", F.posexplode(F.array(*top)).alias("block", "value"))
    # at most 2 ** width rows for each block, whatever the number of fingerprints
    counts = dealt.groupBy("block", "value").count().where(F.col("count") > HOT).select(
        "block", "value", F.ceil(F.col("count") / F.lit(HOT // 2)).cast("int").alias("salts"))
    placed = dealt.join(F.broadcast(counts), ["block", "value"], "left")
    salt = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("salts")).cast("int")
    partner = F.explode(F.when(F.col("salts").isNull(), F.array(F.lit(-1)))
                        .otherwise(F.sequence(F.lit(0), F.col("salts") - 1)))
    rows = placed.withColumn("salt", salt).withColumn("other", partner)
    low = F.when(F.col("other") < 0, F.lit(-1)).otherwise(F.least("salt", "other")).alias("low")
    high = F.when(F.col("other") < 0, F.lit(-1)).otherwise(F.greatest("salt", "other")).alias("high")
    rows = rows.select("fp", "block", "value", F.coalesce("salt", F.lit(-1)).alias("salt"), low, high)
    rows = rows.withColumn("pack", F.when(F.col("low") < 0, F.pmod(F.xxhash64("value"), F.lit(packs)))
                           .otherwise(F.xxhash64("value", "low", "high") % 1_000_000_007 + 10_000_000_000))

    def walk(key, frame: pd.DataFrame) -> pd.DataFrame:
        block = int(key[0])
        off, _ = parts[block]
        v = _rotate(frame["fp"].to_numpy(np.int64).view(np.uint64), off)
        group = frame.groupby(["value", "low", "high"], sort=False).ngroup().to_numpy()
        order = np.lexsort((v, group))
        v, group = v[order], group[order]
        hot = frame["low"].to_numpy()[order]
        both = (hot >= 0) & (hot != frame["high"].to_numpy()[order])
        # within one salt every row has the same side and pairs must not be excluded
        side = np.where(both, frame["salt"].to_numpy()[order], np.arange(len(v)) + 10_000_000)
        masks = []
        for o, w in parts[:block]:
            mask = ((1 << w) - 1) << (64 - o - w)
            masks.append(np.full(len(v), _rotate(np.array([mask], np.uint64), off)[0], np.uint64))
        i, j = trie_links(v, group, side if both.any() else None, budget, masks)
        back = _rotate(v, (64 - off) % 64).view(np.int64)
        return pd.DataFrame({"a": back[i], "b": back[j]})

    return rows.groupBy("block", "pack").applyInPandas(walk, "a bigint, b bigint")


def near_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 4, budget: int = 4) -> DataFrame:
    """``key``, ``fp`` and ``component_id``: the smallest key reachable over links of at most ``budget`` bits.

    Null and empty texts, and texts without words, have fingerprint zero and are linked like any other.
    Repeated rows and equal keys stay as they are, one result row each; an empty table gives no rows. Columns
    other than text and key are neither read nor returned.
    """
    fps = materialise(fingerprints(docs, text, key, width), "fingerprints")
    distinct = fps.groupBy("fp").agg(F.min(key).alias("first"))
    distinct = materialise(distinct, "distinct-fingerprints")
    found = materialise(links(distinct.select("fp"), budget), "trie-links")
    roots = components(found)
    named = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    member = materialise(named.join(least, "root").select("fp", "component_id"), "classes")
    return fps.join(member, "fp").select(key, "fp", "component_id")


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 4, budget: int = 4) -> DataFrame:
    """One row of ``docs`` for every group of near-duplicates, with all its columns.

    The row with the smallest key stays, null keys last, ties by the XXH64 of the text; of rows that repeat in both any
    one. Rows without words are one group. Columns travel as one struct, so no name can clash.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("key"), F.xxhash64(F.coalesce(raw(text), F.lit(b""))).alias("th"),
                       raw(text).alias("raw"))

    def make():
        return lambda k, th, t: (k, th, fingerprint(t, width))

    fps = materialise(map_rows(rows.select("key", "th", "raw"), make, f"key {kind}, th bigint, fp bigint"), "fingerprints")
    distinct = materialise(fps.select("fp").distinct(), "distinct-fingerprints")
    roots = materialise(components(materialise(links(distinct, budget), "trie-links")), "roots")
    own = F.struct(F.col("key").isNull().alias("no"), F.col("key").alias("id"), "th")
    # the least row of each fingerprint, then of each group: no group is gathered
    least = fps.groupBy("fp").agg(F.min(own).alias("own"))
    least = least.join(roots, least.fp == roots.node, "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("own").alias("own"))
    kept = least.select(F.col("own.id").alias("k"), F.col("own.th").alias("h"))
    same = [F.col("th") == F.col("h"), F.col("key").eqNullSafe(F.col("k"))]
    times = fps.join(kept, same, "left_semi").groupBy(F.col("key").alias("k"), F.col("th").alias("h")).agg(F.count("*").alias("times"))
    times = materialise(times, "kept-rows")
    single = rows.join(times.where("times = 1"), same, "left_semi")
    tied = rows.join(times.where("times > 1"), same, "left_semi").groupBy("key", "th").agg(F.first("row").alias("row"))
    return single.select("row.*").unionByName(tied.select("row.*"))


def hexed(fp: str):
    """Sixteen lowercase hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
