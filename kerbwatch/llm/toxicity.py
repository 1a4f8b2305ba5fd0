"""Toxicity scores: logistic regression by FTRL-proximal over hashed words, word pairs and skip-grams.

Learning takes about ``SAMPLE`` labelled rows at most (chosen by a hash of their id), a bounded number, in one
task: FTRL-proximal is a sequence of steps, with a rate for each coordinate. L1 is larger than what one row can
add up over all passes, so features of a single row never get a weight. Few weights are left, at most
``2 ** BITS``, which is the proven size of what goes to every task. Scoring reads each whole text once and needs
no shuffle.

Null and empty texts have no features and get the intercept's score. Labels that are null are not learned
from; of repeated labels of a document the largest counts. Without usable labels every score is the 0.5 of
an empty model. Each document row is scored on its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbwatch.llm.common import raw
from kerbwatch.llm.decontam import _FOLD
from kerbwatch.session import ship_package

BITS = 18
SAMPLE = 12_000
EPOCHS = 8
ALPHA, BETA, L1, L2 = 1.0, 1.0, 12.0, 1.0
#: Sampled rows a feature must be in to take part in learning.
LEAST_ROWS = 3
#: Bytes of text that are hashed together.
BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


class Features:
    """Feature numbers of many texts at once, by array operations over their bytes."""

    def __init__(self, bits: int = BITS):
        self.shift = np.uint64(64 - bits)
        self.power = self.inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, BLOCK + 1024)
            back = np.uint64(pow(int(_BASE), -1, 1 << 64))
            self.power = np.cumprod(np.r_[np.uint64(1), np.full(n, _BASE)], dtype=np.uint64)
            self.inverse = np.cumprod(np.r_[np.uint64(1), np.full(n, back)], dtype=np.uint64)

    def _words(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every word of folded bytes."""
        b = np.frombuffer(data, np.uint8)
        self._powers(len(b) + 1)
        inside = np.r_[False, b != 32, False]
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edge[::2], edge[1::2]
        total = np.r_[np.uint64(0), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.power[:len(b)], dtype=np.uint64)]
        return start, self._mixed((total[end] - total[start]) * self.inverse[start])

    @staticmethod
    def _mixed(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(33))) * _MIX
        return h ^ (h >> np.uint64(29))

    def pieces(self, texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(number of the text, feature) pairs, a block of texts at a time; a pair may come more than once."""
        held, where, size = [], [], 0
        for i, text in enumerate(texts):
            for part in _parts(text.translate(_FOLD) if text else b""):
                if held and size + len(part) > BLOCK:
                    yield self._block(held, where)
                    held, where, size = [], [], 0
                held.append(part)
                where.append(i)
                size += len(part) + 1
        if held:
            yield self._block(held, where)

    def _block(self, held: list[bytes], where: list[int]) -> tuple[np.ndarray, np.ndarray]:
        start, word = self._words(b" ".join(held))
        begins = np.cumsum([0, *(len(p) + 1 for p in held)])
        part = np.searchsorted(begins, start, "right") - 1
        text = np.asarray(where)[part]
        out = [(text, word)]
        for gap, salt in ((1, np.uint64(0xA24BAED4963EE407)), (2, np.uint64(0x9FB21C651E98DF25))):
            near = part[:-gap] == part[gap:]
            out.append((text[:-gap][near], self._mixed((word[:-gap] * _BASE + word[gap:] + salt)[near])))
        which = np.concatenate([t for t, _ in out])
        return which, (np.concatenate([h for _, h in out]) >> self.shift).astype(np.int64)


def _parts(data: bytes) -> Iterator[bytes]:
    """A long text in blocks cut between words; a block begins with the last two words before it."""
    at = 0
    while len(data) - at > BLOCK:
        cut = data.rfind(b" ", at, at + BLOCK)
        if cut <= at:
            cut = data.find(b" ", at + BLOCK)
            if cut < 0:
                break
        yield data[at:cut]
        back = cut
        for _ in range(2):
            while back > at and data[back - 1] == 32:
                back -= 1
            while back > at and data[back - 1] != 32:
                back -= 1
        at = back if back > at else cut
    yield data[at:]


def ftrl(rows: list[tuple[np.ndarray, int]], bits: int, epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA,
         l1: float = L1, l2: float = L2) -> tuple[np.ndarray, float]:
    """Weights and intercept (not regularised) after ``epochs`` passes over (features, label) rows."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    free = 1 << bits  # the intercept's place

    def weights(at):
        zz = z[at]
        w = (np.sign(zz) * l1 - zz) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(zz) <= l1, 0.0, w)

    def intercept():
        return -z[free] / ((beta + np.sqrt(n[free])) / alpha)

    for _ in range(epochs):
        for at, label in rows:
            w, b = weights(at), intercept()
            g = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35))) - label
            root = np.sqrt(n[at])
            n[at] += g * g
            z[at] += g - (np.sqrt(n[at]) - root) / alpha * w
            root = np.sqrt(n[free])
            n[free] += g * g
            z[free] += g - (np.sqrt(n[free]) - root) / alpha * b
    return weights(np.arange(1 << bits)), float(intercept())


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        sample: int = SAMPLE, bits: int = BITS) -> dict:
    """Model from the rows of ``labels`` (key, label): sorted feature numbers, their weights, the intercept."""
    ship_package(docs.sparkSession)
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("_label"))
    n = known.count()
    chosen = known.where(F.pmod(F.xxhash64(F.lit("toxicity"), key), F.lit(max(n, 1))) < sample)
    # about `sample` rows at most, by the line above
    rows = docs.select(F.col(key), raw(text).alias("_raw")).join(F.broadcast(chosen), key)
    rows = rows.select(F.xxhash64(F.lit("order"), key).alias("place"), "_label", "_raw")

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features(bits)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                place, label_, texts = (c.to_pylist() for c in batch.slice(lo, 256).columns)
                got = [np.unique(t * (1 << bits) + f) for t, f in make.pieces(texts)]
                both = np.unique(np.concatenate(got)) if got else np.zeros(0, np.int64)
                cuts = np.searchsorted(both, np.arange(len(texts) + 1) << bits)
                out = [(both[a:b] & ((1 << bits) - 1)).astype("<i4").tobytes() for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place, pa.int64()), pa.array(label_, pa.int32()), pa.array(out, pa.binary())],
                    names=["place", "label", "features"])

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["place", "label"])
        data = [np.frombuffer(f, "<i4") for f in frame["features"]]
        often = np.zeros(1 << bits, np.int32)
        for f in data:
            often[f] += 1
        w, b = ftrl([(f[often[f] >= LEAST_ROWS], int(y)) for f, y in zip(data, frame["label"])], bits)
        at = np.flatnonzero(w)
        return pd.DataFrame({"feature": np.r_[at, 1 << bits], "weight": np.r_[w[at], b]})

    features = rows.mapInArrow(shrink, "place bigint, label int, features binary")
    learned = features.groupBy(F.lit(0).alias("all")).applyInPandas(learn, "feature bigint, weight double")
    found = learned.toPandas().sort_values("feature")  # at most 2 ** bits + 1 rows
    inner = found[found["feature"] < 1 << bits]
    return {"bits": bits, "feature": inner["feature"].to_numpy(np.int64), "weight": inner["weight"].to_numpy(float),
            "intercept": float(found.loc[found["feature"] == 1 << bits, "weight"].sum())}


def score(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``score`` (0 to 1) for every row of ``docs``."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        bits, make = m["bits"], Features(m["bits"])
        weight = np.zeros(1 << bits)
        weight[m["feature"]] = m["weight"]
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                piece = batch.slice(lo, 512)
                texts = piece.column(1).to_pylist()
                used = []
                for which, feature in make.pieces(texts):
                    at = np.flatnonzero(weight[feature])
                    used.append(np.unique((which[at] << bits) + feature[at]))
                both = np.unique(np.concatenate(used)) if used else np.zeros(0, np.int64)
                total = np.bincount(both >> bits, weight[both & ((1 << bits) - 1)], len(texts)) + m["intercept"]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))], names=[key, "score"])

    return docs.select(F.col(key), raw(text).alias("_raw")).mapInArrow(body, f"`{key}` {kind}, score double")
