"""SentencePiece encoding by sampling from the piece lattice, and lossless decoding.

Forward filtering adds up, for every place in a text, the weight of all ways to cut the text before it into
pieces; backward sampling then draws one segmentation from the end. The draws are hashes of the row's key and
the place, so a row is cut the same way wherever and whenever it is encoded. No piece goes on after an inner
space, and some bytes are in no longer piece, so the lattice falls apart into chunks. About a megabyte of text is
worked on at a time: its distinct chunks are filtered place by place, all chunks together, and all its chunks
are sampled together, piece by piece. Chunks above ``LONG`` bytes are filtered and sampled one by one, and keep
one number for every place.

Spaces are written as the vocabulary writes them. A byte may always be taken alone as a byte piece, at a
weight that makes it the last resort, so every text can be encoded and decoding gives back its exact bytes,
literal space marks included. Null texts give null; empty texts no pieces. Equal rows are cut alike.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbwatch.llm.common import raw
from kerbwatch.session import ship_package

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Exponent on piece probabilities: 0 draws evenly from all segmentations, large values take the likeliest.
THETA = 1.0
BYTE_WEIGHT = 1e-12
#: Bytes of text worked on together, and the longest chunk that takes part in that.
BLOCK, LONG = 1 << 20, 64
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = "▁"


class Vocabulary:
    """Pieces with their weights, by their bytes; spaces stand for the vocabulary's space mark."""

    def __init__(self, model: bytes, theta: float = THETA):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        plain = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        score = [sp.get_score(i) for i in plain]
        if all(s == int(s) for s in score) and min(score, default=0) < -1000:
            # merge ranks, not log probabilities: take Zipf's law for them (stated pieces have no rank but their place)
            rank = [k if s < -1e6 else -s for k, s in enumerate(score)]
            total = sum(1 / (k + 10) for k in rank)
            score = [-math.log((k + 10) * total) for k in rank]
        self.byte = [0] * 256
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i):
                self.byte[int(sp.id_to_piece(i)[1:-1], 16)] = i
        self.text = {i: sp.id_to_piece(i).replace(_SPACE, " ").encode() for i in plain}
        self.text.update({i: bytes([b]) for b, i in enumerate(self.byte)})
        self.weight = {self.text[i]: (i, math.exp(theta * s)) for i, s in zip(plain, score)}
        inner = set()
        crosses = False
        for piece in self.weight:
            if len(piece) > 1:
                inner.update(piece)
            crosses |= re.search(rb"[^ ] ", piece) is not None
        solo = b"".join(re.escape(bytes([b])) for b in range(256) if b not in inner and b != 32)
        if crosses:
            self.chunks = (lambda text: [text])
        else:
            self.chunks = re.compile(b"[" + solo + b"]| *[^ " + solo + b"]+| +" if solo else b" *[^ ]+| +", re.S).findall
        # every ending of a piece, with the piece's id and log weight where it is one (else -1): a search back from
        # a place stops at the first string that ends no piece
        self.endings: dict[bytes, tuple[int, float]] = {}
        for piece in self.weight:
            for k in range(1, len(piece)):
                self.endings.setdefault(piece[k:], (-1, 0.0))
        self.endings.update({piece: (i, math.log(w)) for piece, (i, w) in self.weight.items()})
        for b in range(256):
            if self.endings.get(bytes([b]), (-1, 0.0))[0] < 0:
                self.endings[bytes([b])] = (self.byte[b], math.log(BYTE_WEIGHT))
        self.longest = max(map(len, self.endings))
        table = sorted((_hash(e), i, w) for e, (i, w) in self.endings.items())
        self.hashes = np.array([h for h, _, _ in table], np.uint64)
        self.ids = np.array([i for _, i, _ in table], np.int32)
        self.logs = np.array([w for _, _, w in table])

    def encode_all(self, texts: list[bytes], seeds: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The piece numbers of all texts in a row, and how many each text has."""
        chunks, per_text = [], []
        for text in texts:
            found = self.chunks(text)
            chunks += found
            per_text.append(len(found))
        if not chunks:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        row = np.repeat(np.arange(len(texts)), per_text)
        begin = np.cumsum(size) - size
        begin -= np.repeat(np.cumsum([0, *map(len, texts[:-1])]), per_text)
        seed = np.array(seeds, np.uint64)[row]
        counts = np.zeros(len(chunks), np.int64)
        steps = []
        short = np.flatnonzero(size <= LONG)
        if len(short):
            number: dict[bytes, int] = {}
            which = np.fromiter((number.setdefault(c, len(number)) for c in chunks if len(c) <= LONG), np.int64, len(short))
            steps = self._sample(self._filter(list(number)), which, short, size, begin, seed)
            for step, (at, _) in enumerate(steps):
                counts[at] = step + 1
        long = {c: self._one(chunks[c], int(begin[c]), seed[c]) for c in np.flatnonzero(size > LONG).tolist()}
        for c, ids in long.items():
            counts[c] = len(ids)
        end = np.cumsum(counts)
        out = np.empty(end[-1], np.int32)
        for step, (at, ids) in enumerate(steps):
            out[end[at] - 1 - step] = ids
        for c, ids in long.items():
            out[end[c] - len(ids): end[c]] = ids
        return out, np.bincount(row, weights=counts, minlength=len(texts)).astype(np.int64)

    def _filter(self, chunks: list[bytes]) -> tuple:
        """Forward filtering of distinct chunks. Place j of the chunk of rank r by length has number first[j] + r."""
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        order = np.argsort(-size, kind="stable")
        rank = np.empty(len(chunks), np.int64)
        rank[order] = np.arange(len(chunks))
        top = int(size.max())
        alive = len(chunks) - np.searchsorted(np.sort(size), np.arange(top + 1))  # chunks that have a place j
        first = np.r_[0, np.cumsum(alive)]
        letters = np.frombuffer(b"".join(chunks), np.uint8).astype(np.uint64)
        place = np.arange(len(letters)) - np.repeat(np.cumsum(size) - size, size) + 1
        of = np.repeat(rank, size)
        node = first[place] + of
        # edges by length: the strings that end at a place and are pieces
        found = []
        at, h, power = np.arange(len(letters)), np.zeros(len(letters), np.uint64), 1
        for length in range(1, self.longest + 1):
            h = h + (letters[at - length + 1] + np.uint64(1)) * np.uint64(power)
            power = power * int(_BASE) % 2**64
            k = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            known = self.hashes[k] == h
            at, h, k = at[known], h[known], k[known]
            piece = self.ids[k] >= 0
            ends = at[piece]
            found.append((node[ends], first[place[ends] - length] + of[ends], k[piece]))
            more = place[at] > length
            at, h = at[more], h[more]
            if not len(at):
                break
        degree = np.zeros(first[-1], np.int64)
        for ends, _, _ in found:
            degree[ends] += 1
        until = np.cumsum(degree)
        free = until - degree
        came, entry = np.empty(until[-1], np.int64), np.empty(until[-1], np.int64)
        for ends, starts, k in reversed(found):  # long pieces first: they are likelier and end the search when sampling
            spot = free[ends]
            came[spot], entry[spot] = starts, k
            free[ends] += 1
        log, total, part = self.logs[entry], np.zeros(first[-1]), np.empty(until[-1])
        for j in range(1, top + 1):
            lo, hi = first[j], first[j + 1]
            e, f = until[lo - 1], until[hi - 1]
            segment, many = until[lo - 1: hi - 1] - e, degree[lo:hi]
            x = log[e:f] + total[came[e:f]]
            best = np.maximum.reduceat(x, segment)
            x = np.exp(x - np.repeat(best, many))
            s = np.add.reduceat(x, segment)
            total[lo:hi] = best + np.log(s)
            part[e:f] = x / np.repeat(s, many)
        run = np.cumsum(part)
        run -= np.repeat(np.r_[0.0, run][until - degree], degree)
        return first, rank, until, degree, came, self.ids[entry], run

    @staticmethod
    def _sample(lattice: tuple, which: np.ndarray, at: np.ndarray, size: np.ndarray, begin: np.ndarray, seed: np.ndarray) -> list:
        """Backward sampling: for every step the chunks that still take a piece, and the piece."""
        first, rank, until, degree, came, ids, run = lattice
        left = size[at]
        node = first[left] + rank[which]
        mine = rank[which]
        steps = []
        while len(at):
            u = _uniform(seed[at], begin[at] + left)
            pick, last = until[node] - degree[node], until[node] - 1
            open_ = np.flatnonzero(u >= run[pick])
            while len(open_):
                open_ = open_[pick[open_] < last[open_]]
                pick[open_] += 1
                open_ = open_[u[open_] >= run[pick[open_]]]
            steps.append((at, ids[pick]))
            node = came[pick]
            left = np.searchsorted(first, node, side="right") - 1
            go = left > 0
            at, node, left = at[go], node[go], left[go]
        return steps

    def _edges(self, chunk: bytes, j: int) -> list[tuple[int, int, float]]:
        """Pieces that end at a place: (start, id, log weight), the longest first."""
        out, get = [], self.endings.get
        for i in range(j - 1, -1, -1):
            found = get(chunk[i:j])
            if found is None:
                break
            if found[0] >= 0:
                out.append((i, *found))
        out.reverse()
        return out

    def _one(self, chunk: bytes, begin: int, seed: np.uint64) -> list[int]:
        """The same for one chunk of any length."""
        total = [0.0]
        for j in range(1, len(chunk) + 1):
            x = [w + total[i] for i, _, w in self._edges(chunk, j)]
            best = max(x)
            total.append(best + math.log(sum([math.exp(v - best) for v in x])))
        out, j = [], len(chunk)
        u = _uniform(np.full(j + 1, seed), begin + np.arange(j + 1))
        while j:
            draw = u[j]
            for start, piece, w in self._edges(chunk, j):
                draw -= math.exp(w + total[start] - total[j])
                if draw < 0:
                    break
            out.append(piece)
            j = start
        return out[::-1]

    def encode(self, text: bytes, seed: int) -> list[int]:
        return self.encode_all([text], [seed])[0].tolist()

    def decode(self, ids) -> bytes:
        text = self.text
        return b"".join([text[i] for i in ids])


def _hash(string: bytes) -> int:
    """Polynomial hash that grows to the left, modulo 2^64."""
    h, power = 0, 1
    for b in reversed(string):
        h, power = (h + (b + 1) * power) % 2**64, power * int(_BASE) % 2**64
    return h


def _uniform(seed: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from seeds and places (SplitMix64)."""
    z = seed + (place.astype(np.uint64) + np.uint64(1)) * _BASE
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _blocks(batch: pa.RecordBatch, rows: int = 1024) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``BLOCK`` bytes of text (the last column)."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(batch.num_columns - 1)), 0).to_pylist()
    lo = held = 0
    for i, n in enumerate(sizes):
        if i > lo and (held + n > BLOCK or i - lo >= rows):
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(sizes):
        yield lo, len(sizes)


def seed_of(key, seed: int) -> int:
    return xxhash.xxh64_intdigest(repr(key), seed)


def _vocabulary(df: DataFrame, model: str):
    """The model file goes to tasks as a broadcast of its bytes (a fixed file of under a megabyte)."""
    ship_package(df.sparkSession)
    with open(model, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL, theta: float = THETA,
           seed: int = 0, keep: tuple[str, ...] = (), digest: bool = False) -> DataFrame:
    """``key``, ``keep`` columns, n_pieces, ids and lossless (decoding gave the text back) for every row.

    With ``digest`` the ids' SHA-256 (32-bit little-endian) stands in their place.
    """
    shared = _vocabulary(docs, model)
    columns = [key, *keep]
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(shared.value, theta)
        for batch in batches:
            for lo, hi in _blocks(batch):
                part = batch.slice(lo, hi - lo)
                keys, texts = part.column(0).to_pylist(), part.column(part.num_columns - 1).to_pylist()
                flat, n = v.encode_all([t or b"" for t in texts], [seed_of(k, seed) for k in keys])
                to = np.cumsum([0, *n])
                same = [t is None or v.decode(flat[a:b].tolist()) == t for t, a, b in zip(texts, to, to[1:])]
                absent = pa.array([t is None for t in texts])
                if digest:
                    raw_ids = flat.astype("<i4")
                    out = pa.array([None if t is None else hashlib.sha256(raw_ids[a:b]).hexdigest() for t, a, b in zip(texts, to, to[1:])], pa.string())
                else:
                    out = pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(flat), mask=absent)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(n, pa.int64()), out, pa.array(same)],
                    names=[*columns, "n_pieces", "ids", "lossless"])

    schema = f"{fields}, n_pieces bigint, ids {'string' if digest else 'array<int>'}, lossless boolean"
    return docs.select(*(F.col(f"`{c}`") for c in columns), raw(text).alias("_raw")).mapInArrow(body, schema)


def decode(encoded: DataFrame, ids: str = "ids", to: str = "text", model: str = MODEL) -> DataFrame:
    """``encoded`` with the text of its piece numbers added; null stays null."""
    from kerbwatch.llm.common import map_rows

    shared = _vocabulary(encoded, model)
    names = encoded.columns
    at = names.index(ids)

    def make():
        v = Vocabulary(shared.value)
        return lambda *row: (*row, None if row[at] is None else v.decode(row[at]))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    out = map_rows(encoded, make, f"{fields}, _raw binary")
    return out.select(*(F.col(f"`{c}`") for c in names), F.col("_raw").cast("string").alias(to))
