"""Ordered rules over a key, run in bounded pieces.

Some rules cannot be written as a window, because a row depends on which earlier rows were kept
(tracking, cooldown, near-duplicate suppression). Running them "per camera" would put a whole camera into
one task. ``run_rule`` cuts every key into time chunks instead:

1. each chunk starts empty, some seconds early (the warm-up rows are read but emit nothing), and reports
   its memory at its first own row and at its end;
2. neighbouring chunks are compared: where the memory a chunk started from is not the memory its
   predecessor ended with, the chunk runs again from the true one, until all agree.

The result is the one a single pass gives, whatever the chunk length. A task streams over sorted rows and
holds one rule's memory, never a group.

Identifiers a rule hands out are local to a chunk (new ones count from 1, inherited ones are negative slot
numbers) and become one numbering per key in ``resolve_ids``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kerbwatch.operators.pointers import same_keys as _join_same
from kerbwatch.session import materialise, ship_package

CHUNK_SECONDS = 900.0
WARM_SECONDS = 30.0
_MEMORY = "array<struct<sig:string,t:double,id:bigint>>"


class Rule:
    """One ordered rule. Subclasses hold their memory as slots and say what each row yields.

    ``inputs`` are the value columns ``row`` receives, ``outputs`` the schema of what it returns (``None``
    drops the row), ``memory`` the seconds after which a slot can no longer matter, ``new_id`` the output with the
    identifiers it hands out, if it does.
    """

    inputs: tuple[str, ...] = ()
    outputs: str = ""
    new_id: str | None = None
    memory: float = float("inf")

    def __init__(self) -> None:
        self.next_id = 1

    def load(self, slots: list[tuple[list, int]]) -> None:
        raise NotImplementedError

    def slots(self, now: float) -> list[tuple[list, float, int]]:
        """(content, time, id) of everything that still matters at ``now``."""
        raise NotImplementedError

    def begin_frame(self, now: float) -> None:
        """Called before the first row of each new order position."""

    def row(self, now: float, *values):
        raise NotImplementedError

    # -- shared by the chunked and the streaming runner

    def rebase(self, now: float) -> list[tuple[str, float, int]]:
        """Renumber what is alive to slots -1, -2, … and return it."""
        kept = self.slots(now)
        self.load([(content, -(i + 1)) for i, (content, _, _) in enumerate(kept)])
        self.next_id = 1
        return [(json.dumps(content), t, -(i + 1)) for i, (content, t, _) in enumerate(kept)]

    def dump(self, now: float) -> str:
        return json.dumps({"next": self.next_id, "slots": [(c, i) for c, _, i in self.slots(now)]})

    def restore(self, text: str | None) -> None:
        state = json.loads(text) if text else {"next": 1, "slots": []}
        self.load([(c, i) for c, i in state["slots"]])
        self.next_id = state["next"]


def _scan(rule: Rule, n_keys: int, n_keep: int, n_order: int, schema: T.StructType):
    """Task body: stream over rows sorted by key, chunk and order. Columns that are kept never become Python objects: they
    are taken from the batch by row number."""
    n_out = len(schema) - n_keys - n_keep - 6
    arrow = to_arrow_schema(schema)
    first_keep = n_keys + 4 + n_order

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = frame = first = None
        entry: list | None = None
        now = 0.0
        ends: list[tuple] = []

        def close():
            if entry is not None:
                left = [(json.dumps(c), t, i) for c, t, i in rule.slots(now)]
                ends.append((group, first, _memory(entry), _memory(left), rule.next_id - 1))

        def closed() -> pa.RecordBatch:
            n = len(ends)
            groups, *marks = zip(*ends)
            keys = list(zip(*groups))
            columns = [[1] * n, keys[-1], *keys[:-1], *[[None] * n] * (n_keep + n_out), *marks]
            ends.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

        def found(batch: pa.RecordBatch, at: list[int], results: list[tuple]) -> pa.RecordBatch:
            rows, n = pa.array(at, pa.int64()), len(at)
            given = [pa.repeat(pa.scalar(0, pa.int32()), n)]
            given += [batch.column(i).take(rows) for i in (n_keys, *range(n_keys), *range(first_keep, first_keep + n_keep))]
            given = [c if c.type == f.type else c.cast(f.type) for c, f in zip(given, arrow)]
            made = [pa.array(c, type=f.type) for c, f in zip(zip(*results), list(arrow)[len(given):])]
            return pa.RecordBatch.from_arrays([*given, *made, *(pa.nulls(n, f.type) for f in list(arrow)[-4:])], schema=arrow)

        for batch in batches:
            at, results = [], []
            columns = [c.to_pylist() for i, c in enumerate(batch.columns) if not first_keep <= i < first_keep + n_keep]
            for row, values in enumerate(zip(*columns)):
                here = values[: n_keys + 1]
                warm, given, now_ = values[n_keys + 1: n_keys + 4]
                if here != group:
                    close()
                    group, frame, entry = here, None, None
                    rule.load([])
                    rule.next_id = 1
                now = now_
                if entry is None and not warm:
                    first = now
                    if given is not None:
                        rule.load([(json.loads(s["sig"]), -(i + 1)) for i, s in enumerate(given)])
                        rule.next_id = 1
                        entry = [(s["sig"], s["t"], -(i + 1)) for i, s in enumerate(given)]
                    else:
                        entry = rule.rebase(now)
                if (now, values[n_keys + 4]) != frame:
                    frame = (now, values[n_keys + 4])
                    rule.begin_frame(now)
                result = rule.row(now, *values[first_keep:])
                if result is not None and not warm:
                    at.append(row)
                    results.append(result)
            if at:
                yield found(batch, at, results)
            if len(ends) >= 10_000:
                yield closed()
        close()
        if ends:
            yield closed()

    return body


def _memory(slots) -> list[dict]:
    return [{"sig": s, "t": t, "id": i} for s, t, i in slots]


def run_rule(df: DataFrame, rule: Rule, keys: Sequence[str], order: Sequence[str], keep: Sequence[str],
             time: str = "ts_sec", chunk_seconds: float = CHUNK_SECONDS, warm_seconds: float = WARM_SECONDS,
             new_id: str | None = None) -> DataFrame:
    """Apply ``rule`` per key by ``time``, then ``order``, and return ``keys + keep + rule.outputs``.

    ``time`` comes first, so a frame counter may start again. Time and ``order[0]`` are the frame position; rows that
    share them share one ``begin_frame``. ``new_id`` names the output column whose local identifiers are to be resolved.
    """
    ship_package(df.sparkSession)
    keys, order, keep = list(keys), list(order), list(keep)
    out_fields = T._parse_datatype_string(rule.outputs).fields
    schema = T.StructType([
        T.StructField("_kind", T.IntegerType()), T.StructField("_chunk", T.LongType()),
        *(T.StructField(c, df.schema[c].dataType) for c in (*keys, *keep)), *out_fields,
        T.StructField("_t0", T.DoubleType()), T.StructField("_entry", T._parse_datatype_string(_MEMORY)),
        T.StructField("_exit", T._parse_datatype_string(_MEMORY)), T.StructField("_new", T.LongType()),
    ])
    body = _scan(rule, len(keys), len(keep), len(order), schema)
    own = F.floor(F.col(time) / chunk_seconds).cast("bigint")

    def scan(rows: DataFrame) -> DataFrame:
        columns = [F.col(c) for c in (*keys, "_chunk", "_warm", "_given")] + [F.col(time).alias("_now")]
        columns += [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
        columns += [F.col(c).alias(f"_p{i}") for i, c in enumerate((*keep, *rule.inputs))]
        # a fixed number: the rule is bound by Python time, not by the bytes adaptive coalescing looks at
        parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        placed = rows.select(*columns).repartition(parts, *keys, "_chunk")
        ordered = placed.sortWithinPartitions(*keys, "_chunk", "_now", *(f"_o{i}" for i in range(len(order))))
        return ordered.mapInArrow(body, schema)

    late = F.col(time) - own * chunk_seconds >= chunk_seconds - warm_seconds
    places = F.array_compact(F.array(
        F.struct(own.alias("_chunk"), F.lit(False).alias("_warm")),
        F.when(late & F.lit(warm_seconds > 0), F.struct((own + 1).alias("_chunk"), F.lit(True).alias("_warm")))))
    first_try = df.withColumn("_place", F.explode(places)).select("*", "_place.*").drop("_place")
    rounds = [materialise(scan(first_try.withColumn("_given", F.lit(None).cast(_MEMORY))), "rule", "_kind")]
    ends, redone = rounds[0].where("_kind = 1"), None

    # a round writes the chunks it runs again and nothing else
    while True:
        bounds = _neighbours(ends, keys, rule.memory)
        wrong = bounds.where(_signature("_entry") != _signature("_inherited")).select(
            *keys, "_chunk", F.col("_inherited").alias("_given"))
        if not wrong.take(1):
            break
        wrong = materialise(wrong, "rule-again")
        own_rows = df.withColumn("_chunk", own).withColumn("_warm", F.lit(False))
        again = _join_same(own_rows, wrong, [*keys, "_chunk"], "inner")
        rounds.append(materialise(scan(again), "rule", "_kind"))
        kept = _join_same(ends, wrong.drop("_given"), [*keys, "_chunk"], "left_anti")
        ends = materialise(kept.unionByName(rounds[-1].where("_kind = 1")), "rule-ends")
        new = wrong.select(*keys, "_chunk", F.lit(len(rounds) - 1).alias("_round"))
        redone = new if redone is None else redone.unionByName(new)

    rows = rounds[0].where("_kind = 0")
    if redone is not None:
        last = redone.groupBy(*keys, "_chunk").agg(F.max("_round").alias("_last"))
        every = None
        for n, table in enumerate(rounds):
            part = table.where("_kind = 0").withColumn("_round", F.lit(n))
            every = part if every is None else every.unionByName(part)
        rows = _join_same(every, last, [*keys, "_chunk"], "left").where("coalesce(_last, 0) = _round").drop("_last", "_round")
    names = [*keys, *keep, *(f.name for f in out_fields)]
    if new_id is None:
        return rows.select(*names)
    return resolve_ids(rows, bounds, keys, new_id).select(*names)


def _signature(name: str) -> Column:
    return F.transform(name, lambda s: s.getField("sig"))


def _neighbours(ends: DataFrame, keys: Sequence[str], memory: float) -> DataFrame:
    """One row per chunk with what its predecessor left behind, as of the chunk's first row."""
    by_time = Window.partitionBy(*keys).orderBy("_chunk")
    bounds = ends.select(
        *keys, "_chunk", "_t0", "_entry", "_exit", "_new",
        F.lag("_exit").over(by_time).alias("_left"), F.lag("_chunk").over(by_time).alias("_before"),
        F.coalesce(F.sum("_new").over(by_time.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    alive = F.filter("_left", lambda s: F.col("_t0") - s.getField("t") <= F.lit(memory))
    return bounds.withColumn("_inherited", F.coalesce(alive, F.array().cast(_MEMORY))).drop("_left")


def resolve_ids(rows: DataFrame, bounds: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Local identifiers to one numbering per key, in order of first appearance.

    A new identifier is shifted by the number handed out in earlier chunks. An inherited one is followed
    back to the chunk that created it, doubling the distance in every step.
    """
    keys = list(keys)
    offsets = bounds.select(*keys, "_chunk", "_offset")
    links = (bounds.select(*keys, "_chunk", "_before", F.posexplode("_inherited").alias("_pos", "_slot"))
             .select(*keys, "_chunk", (-F.col("_pos") - 1).cast("bigint").alias("_id"),
                     F.col("_before").alias("_from"), F.col("_slot.id").alias("_origin")))
    links = materialise(links, "id-links")
    while links.where("_origin < 0").take(1):
        back = links.select(*keys, F.col("_chunk").alias("_from"), F.col("_id").alias("_origin"),
                            F.col("_from").alias("_from2"), F.col("_origin").alias("_origin2"))
        links = (_join_same(links, back, [*keys, "_from", "_origin"], "left")
                 .withColumn("_from", F.coalesce("_from2", "_from"))
                 .withColumn("_origin", F.coalesce("_origin2", "_origin")).drop("_from2", "_origin2"))
        links = materialise(links, "id-links")
    start = offsets.withColumnRenamed("_chunk", "_from")
    roots = _join_same(links, start, [*keys, "_from"], "inner").select(
        *keys, "_chunk", F.col("_id").alias("_local"), (F.col("_offset") + F.col("_origin")).alias("_global"))
    named = rows.withColumn("_local", F.col(column))
    named = _join_same(named, roots, [*keys, "_chunk", "_local"], "left")
    named = _join_same(named, offsets, [*keys, "_chunk"], "left")
    return named.withColumn(column, F.when(F.col("_local") > 0, F.col("_offset") + F.col("_local"))
                            .otherwise(F.col("_global")))
