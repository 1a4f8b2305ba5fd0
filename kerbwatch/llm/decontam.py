"""Benchmark decontamination with a generalised suffix automaton over the items' words.

Words are lower-cased runs of letters, digits and non-ASCII characters. The automaton of a shard of items is
small (``SHARD_WORDS`` words) and goes to every task; documents stream through it where they lie, without a
shuffle. Per word it keeps the length of the longest match that ends there. Only runs of word pairs that
occur in the items can hold a match, so those are found first with array operations and the automaton walks
these runs alone. Larger item sets take several shards, one pass for each, with the hits carried along.

Null and empty texts have no words and no hits. Items without words have no window. Repeated documents and
repeated items are each judged on their own. With an empty item table nothing is hit.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbwatch.llm.common import map_rows, raw
from kerbwatch.session import materialise

WINDOW = 10
#: Item words in one automaton: it has at most twice as many states, about 60 MB in a task.
SHARD_WORDS = 150_000
#: A document of which more words than this share are hit goes as a whole.
MAX_COVERAGE = 0.5

_LETTER = bytes(b"0123456789abcdefghijklmnopqrstuvwxyz") + bytes(range(128, 256))
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b in _LETTER else 32 for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class Automaton:
    """Generalised suffix automaton of word sequences, with the items behind every window."""

    def __init__(self, items: Iterable[tuple], window: int = WINDOW):
        self.window, self.vocabulary = window, {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences, pairs, self.shortest = [], set(), window
        for item, tokens in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in tokens]
            if not ids:
                continue
            sequences.append((item, ids))
            self.shortest = min(self.shortest, len(ids))
            pairs.update(zip(ids, ids[1:]))
            last = 0
            for word in ids:
                last = self._extend(last, word)
        self.pairs = np.array(sorted(a * len(self.vocabulary) + b for a, b in pairs), np.int64)
        self.full = self._climb()
        self.items: dict[int, set] = defaultdict(set)
        self.ends: dict[int, list[tuple[int, object]]] = defaultdict(list)
        for item, ids in sequences:
            state = 0
            for i, word in enumerate(ids):
                state = self.step[state][word]
                if i + 1 >= window:
                    self.items[self.full[state]].add(item)
            if len(ids) < window:
                self.ends[state].append((len(ids), item))
        self.items, self.ends = dict(self.items), dict(self.ends)
        self.short = self._short_chains()

    def _extend(self, last: int, word: int) -> int:
        step, link, length = self.step, self.link, self.length
        if word in step[last]:
            q = step[last][word]
            return q if length[q] == length[last] + 1 else self._clone(last, word, q)
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and word not in step[p]:
            step[p][word] = new
            p = link[p]
        if p >= 0:
            q = step[p][word]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, word, q)
        return new

    def _clone(self, p: int, word: int, q: int) -> int:
        step, link, length = self.step, self.link, self.length
        copy = len(step)
        step.append(dict(step[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = copy
        while p >= 0 and step[p].get(word) == q:
            step[p][word] = copy
            p = link[p]
        return copy

    def _climb(self) -> list[int]:
        """For each state the suffix state that holds its last ``window`` words, or -1."""
        up = [-1] * len(self.link)
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            if self.length[s] >= self.window:
                up[s] = s if self.length[self.link[s]] < self.window else up[self.link[s]]
        return up

    def _short_chains(self) -> dict[int, tuple]:
        """For each state the short items that end in it, by length."""
        out: dict[int, tuple] = {}
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            chain = tuple(self.ends.get(s, ())) + out.get(self.link[s], ())
            if chain:
                out[s] = chain
        return out

    def scan(self, tokens: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Maximal runs [a, b) of hit words, and the items of which a window occurs."""
        n = len(tokens)
        if n < self.shortest or not self.vocabulary:
            return [], set()
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in tokens), np.int64, n)
        runs, found = [], set()
        for a, b in self._candidates(ids):
            self._walk(ids[a:b].tolist(), a, runs, found)
        return joined(runs), found

    def _candidates(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of words whose neighbouring pairs all occur in the items, as long as the shortest window."""
        known = ids >= 0
        pair = known[:-1] & known[1:]
        at = np.flatnonzero(pair)
        if len(at) and len(self.pairs):
            code = ids[at] * len(self.vocabulary) + ids[at + 1]
            place = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            pair[at] = self.pairs[place] == code
        else:
            pair[:] = False
        linked = np.r_[False, pair, False]  # linked[i]: word i - 1 goes on in word i
        start = np.flatnonzero(known & ~linked[:-1])
        end = np.flatnonzero(known & ~linked[1:]) + 1
        keep = end - start >= self.shortest
        yield from zip(start[keep].tolist(), end[keep].tolist())

    def _walk(self, ids: list[int], at: int, runs: list, found: set) -> None:
        step, link, length, window = self.step, self.link, self.length, self.window
        state = matched = 0
        for i, word in enumerate(ids, at + 1):
            while state and word not in step[state]:
                state = link[state]
                matched = length[state]
            if word in step[state]:
                state, matched = step[state][word], matched + 1
            if matched >= window:
                here = state  # the match may be shorter than the state's longest word
                runs.append((i - matched, i))
                found |= self.items[self.full[here]]
            for size, item in self.short.get(state, ()):
                if size <= matched:
                    runs.append((i - size, i))
                    found.add(item)


def joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    """The text with the given word runs cut out, from a run's first letter to its last."""
    spans = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for a, b in runs:
        out.append(text[at:spans[a][0]])
        at = spans[b - 1][1]
    return b"".join([*out, text[at:]])


def shards(items: DataFrame, key: str, text: str, limit: int) -> Iterator[list[tuple]]:
    """The items in lists of at most ``limit`` words (or one item); one list is held at a time."""
    held, size = [], 0
    for item, value in items.select(key, raw(text)).toLocalIterator():
        tokens = words(bytes(value)) if value is not None else []
        if held and size + len(tokens) > limit:
            yield held
            held, size = [], 0
        held.append((item, tokens))
        size += len(tokens)
    yield held


def hits(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
         item_text: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS,
         finish: Callable | None = None, schema: str | None = None) -> DataFrame:
    """For every row of ``docs``: key, the runs of hit words and the items (as text) behind them.

    ``finish(key, text, runs, items, automata)`` may make other columns (``schema``) of these in the last pass.
    """
    kind = docs.schema[key].dataType.simpleString()
    state = f"key {kind}, text binary, runs array<struct<a:int,b:int>>, items array<string>"
    frame = docs.select(F.col(key).alias("key"), raw(text).alias("text"),
                        F.lit(None).cast("array<struct<a:int,b:int>>").alias("runs"),
                        F.lit(None).cast("array<string>").alias("items"))
    done = finish or (lambda k, t, runs, found: (k, [{"a": a, "b": b} for a, b in runs], found))
    out = schema or f"{key} {kind}, runs array<struct<a:int,b:int>>, items array<string>"
    parts = shards(items, item_key, item_text, shard_words)
    part = next(parts)
    while part is not None:
        following = next(parts, None)
        shared = docs.sparkSession.sparkContext.broadcast(Automaton(part, window))
        last = following is None

        def make(shared=shared, last=last):
            automaton = shared.value

            def row(k, t, runs, found):
                new, more = automaton.scan(words(t))
                runs = joined([(r["a"], r["b"]) for r in runs or ()] + new)
                found = sorted({*(found or ()), *map(str, more)})
                return done(k, t, runs, found) if last else (k, t, [{"a": a, "b": b} for a, b in runs], found)

            return row

        frame = map_rows(frame, make, out if last else state)
        if not last:
            frame = materialise(frame, "decontamination")
        part = following
    return frame


def report(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``docs``."""
    def finish(k, text, runs, found):
        n_hit = sum(b - a for a, b in runs)
        return (k, len(words(text)), n_hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), n_hit > 0)

    kind = docs.schema[names.get("key", "doc_id")].dataType.simpleString()
    return hits(docs, items, finish=finish, **names,
                schema=f"doc_id {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean")


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", max_coverage: float = MAX_COVERAGE,
                  window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` with every span of a benchmark window cut out of ``text``; a document with more than
    ``max_coverage`` of its words hit goes. Hits are those of all shards together, on the same text; cutting is
    repeated until the joined rest has no window of any shard. The number of shards does not change the result.
    All other columns stay as they are; the text of a clean document is unchanged.
    """
    rest = [c for c in docs.columns if c != text]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest), "_raw binary", "_runs array<struct<a:int,b:int>>"])
    frame = docs.select(*(F.col(f"`{c}`") for c in rest), raw(F.col(f"`{text}`")).alias("_raw"),
                        F.lit(None).cast("array<struct<a:int,b:int>>").alias("_runs"))
    settled = None
    while True:
        parts = shards(items, "item_id", "text", shard_words)
        part, single = next(parts), True
        while part is not None:
            following = next(parts, None)
            last = following is None
            single = single and last
            shared = docs.sparkSession.sparkContext.broadcast(Automaton(part, window))

            def make(shared=shared, last=last, single=single):
                automaton = shared.value

                def row(*values):
                    *others, value, runs = values
                    while True:
                        tokens = words(value)
                        runs = joined([(r["a"], r["b"]) for r in runs or ()] + automaton.scan(tokens)[0])
                        if not last:
                            return (*others, value, [{"a": a, "b": b} for a, b in runs])
                        if not runs:
                            return (*others, value, None)
                        if sum(b - a for a, b in runs) > max_coverage * len(tokens):
                            return None
                        value, runs = without(value, runs), []
                        if not single:
                            return (*others, value, runs)  # not null: all shards look at it once more

                return row

            frame = materialise(map_rows(frame, make, schema), "decontaminated")
            part = following
        done = frame.where("_runs IS NULL")
        settled = done if settled is None else settled.unionByName(done)
        frame = frame.where("_runs IS NOT NULL")
        if single or frame.isEmpty():
            break
    return settled.select(*(F.col("_raw").cast("string").alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns))
