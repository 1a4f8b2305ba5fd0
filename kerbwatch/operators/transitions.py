"""The line checker as composed transitions, for tracks of any length.

What the checker reports depends on the sides it remembers, and these on all earlier rows of the track. So every chunk
of a track is turned into a table first: for each kind of memory it may begin with, which memory it ends with and
which crossings it reports. Kinds are found while reading: a line whose remembered side is not known yet splits them
only where it matters (within reach, a crossing if the memory holds the other side), and equal memories run on as one.
After a few rows one memory is left, and what it reports holds whatever came before. A second scan composes the
tables of a track, one row for each chunk; it says which kind each chunk began with, and only reports
under another kind are left out. Every row is read once; no chunk is run again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kerbwatch.operators.fold import CHUNK_SECONDS
from kerbwatch.operators.pointers import same_keys
from kerbwatch.session import materialise, ship_package

NAMES = {"L": "left", "R": "right"}
OTHER = {"L": "R", "R": "L"}
#: A side that the chunk has not seen itself.
UNKNOWN = "?"

_BRANCHES = "array<struct<fresh:boolean,asked:array<struct<line:int,letter:string,holds:boolean>>,left:string,path:array<int>>>"
Memory = tuple[str, ...]


def outcomes(memory: Memory, sides: str) -> Iterator[tuple[tuple, Memory, tuple[int, str, str] | None]]:
    """(conditions on unknown sides, memory afterwards, crossing) of one sighting; the conditions exclude each other.

    Lines are looked at in order and the first one crossed ends the sighting, so those behind it keep their side.
    """
    kept, asked = list(memory), ()
    for i, letter in enumerate(sides):
        if letter in "-0":
            kept[i] = "-" if letter == "-" else kept[i]  # a line that may be crossed is not remembered
            continue
        side, before = letter.upper(), kept[i]
        kept[i] = side
        if letter != side or before == side:
            continue
        crossed = (i, NAMES[OTHER[side]], NAMES[side])
        if before == UNKNOWN:
            yield (*asked, (i, OTHER[side], True)), tuple(kept), crossed
            asked = (*asked, (i, OTHER[side], False))
        elif before == OTHER[side]:
            yield asked, tuple(kept), crossed
            return
    yield asked, tuple(kept), None


class Table:
    """The transitions of one chunk while its rows are read."""

    def __init__(self) -> None:
        #: memory -> kinds of beginnings that lead to it: (starts afresh, conditions, numbers of their reports)
        self.now: dict[Memory, list[tuple[bool, tuple, tuple[int, ...]]]] = {}
        self.first = self.last = None
        self.reports = 0

    def sight(self, index: int, sides: str) -> list[tuple[int | None, tuple[int, str, str]]]:
        """Crossings of this sighting with their number; None for those that hold under every kind."""
        seen = tuple(sides.upper())
        if self.last is None:
            self.first, fresh = index, [(True, (), ())]
            self.now = {(UNKNOWN,) * len(sides): [(False, (), ())]}
            found = self._step(sides)
            self.now.setdefault(seen, []).extend(fresh)
        elif index != self.last + 1:
            # the track was missing from a frame: whatever was remembered is gone
            self.now = {seen: [kind for kinds in self.now.values() for kind in kinds]}
            found = []
        else:
            found = self._step(sides)
        self.last = index
        return found

    def _step(self, sides: str) -> list[tuple[int | None, tuple[int, str, str]]]:
        after: dict[Memory, list] = {}
        found, alone = [], len(self.now) == 1
        for memory, kinds in self.now.items():
            for asked, left, crossed in outcomes(memory, sides):
                number: tuple[int, ...] = ()
                if crossed is not None:
                    # known to hold under every kind: one memory, no question, and not the row a fresh start only records
                    if alone and not asked and self.last is not None:
                        found.append((None, crossed))
                    else:
                        number = (self.reports,)
                        found.append((self.reports, crossed))
                        self.reports += 1
                after.setdefault(left, []).extend((fresh, had + asked, path + number) for fresh, had, path in kinds)
        self.now = after
        return found

    def branches(self) -> list[dict]:
        return [{"fresh": fresh, "asked": [{"line": i, "letter": s, "holds": h} for i, s, h in asked], "left": "".join(memory),
                 "path": list(path)} for memory, kinds in self.now.items() for fresh, asked, path in kinds]


def chosen(branches: list[dict], entry: str | None) -> tuple[str, list[int]]:
    """The memory a chunk ends with and the numbers of its reports, given the memory it begins with (None: afresh)."""
    for b in branches:
        if b["fresh"] != (entry is None):
            continue
        if entry is None or all((entry[a["line"]] == a["letter"]) == a["holds"] for a in b["asked"]):
            left = b["left"] if entry is None else "".join(e if x == UNKNOWN else x for x, e in zip(b["left"], entry))
            return left, b["path"]
    raise ValueError("the kinds of a chunk cover every memory")


def _take(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def checked(rows: DataFrame, keys: Sequence[str], keep: Sequence[str], time: str = "ts_sec",
            chunk_seconds: float = CHUNK_SECONDS) -> DataFrame:
    """keys, keep, line_id, from_side and to_side of each reported crossing; rows carry ``frame_index`` and ``sides``."""
    ship_package(rows.sparkSession)
    keys, keep = list(keys), list(keep)
    fields = [rows.schema[c] for c in (*keys, *keep)]
    schema = T.StructType([
        T.StructField("_summary", T.BooleanType()), T.StructField("_chunk", T.LongType()), *(T.StructField(f.name, f.dataType) for f in fields),
        *T._parse_datatype_string("line_id int, from_side string, to_side string, _number int").fields,
        *T._parse_datatype_string(f"_first bigint, _last bigint, _branches {_BRANCHES}").fields])
    arrow, nk, nv = to_arrow_schema(schema), len(keys), len(keep)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, table, out = None, Table(), []

        def close() -> None:
            if group is not None:
                out.append((True, group[-1], *group[:-1], *[None] * (nv + 4), table.first, table.last, table.branches()))

        for batch in batches:
            for values in zip(*(c.to_pylist() for c in batch.columns)):
                here, (index, sides), kept = values[:nk + 1], values[nk + 2:nk + 4], values[nk + 4:]
                if here != group:
                    close()
                    group, table = here, Table()
                for number, crossed in table.sight(index, sides):
                    out.append((False, here[-1], *here[:-1], *kept, *crossed, number, None, None, None))
            if len(out) >= 20_000:
                yield _take(out, arrow)
                out.clear()
        close()
        if out:
            yield _take(out, arrow)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # Python time binds, not bytes
    chunk = F.floor(F.col(time) / F.lit(chunk_seconds)).cast("bigint")
    placed = rows.where(F.col("sides").isNotNull()).select(
        *keys, chunk.alias("_chunk"), F.col(time).alias("_time"), F.col("frame_index").cast("bigint").alias("_index"), "sides",
        *(F.col(c).alias(f"_v_{c}") for c in keep))
    placed = placed.repartition(parts, *keys, "_chunk").sortWithinPartitions(*keys, "_chunk", "_time", "_index")
    result = materialise(placed.mapInArrow(read, schema), "transitions", "_summary")

    summaries = result.where("_summary").select(*keys, "_chunk", "_first", "_last", "_branches")
    out_schema = T.StructType([*(T.StructField(k, rows.schema[k].dataType) for k in keys),
                               *T._parse_datatype_string("_chunk bigint, _number int").fields])
    arrow_out = to_arrow_schema(out_schema)

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, memory, last, out = None, None, None, []
        for batch in batches:
            for values in zip(*(c.to_pylist() for c in batch.columns)):
                here, (chunk, first, end, branches) = values[:nk], values[nk:]
                goes_on = here == key and last is not None and first == last + 1
                memory, path = chosen(branches, memory if goes_on else None)
                key, last = here, end
                out += [(*here, chunk, n) for n in path]
            if out:
                yield _take(out, arrow_out)
                out.clear()

    ordered = summaries.repartition(*keys).sortWithinPartitions(*keys, "_chunk")
    valid = ordered.mapInArrow(compose, out_schema)
    reports = result.where("NOT _summary")
    held = same_keys(reports.where("_number IS NOT NULL"), valid, [*keys, "_chunk", "_number"], "left_semi")
    columns = [*keys, *keep, "line_id", "from_side", "to_side"]
    return reports.where("_number IS NULL").select(*columns).unionByName(held.select(*columns))
