"""Chains of moments by jump pointers: which rows a "not again within so many seconds" rule keeps.

From every moment of a key one pointer leads to the first moment far enough behind it. The kept rows are those
on the path that starts at the key's first moment. Pointers are doubled round by round; a round keeps only the
moments that some pointer of the last round still reaches, so its tables shrink as paths run together. Then the
marks go down the rounds: the first moment marks its neighbour at the longest distance, both mark theirs at half of it,
and so on. Rounds grow with the logarithm of the longest chain; nothing is walked row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbwatch.operators.prefix import with_last_value, with_previous
from kerbwatch.session import materialise

_MOMENT = "struct<at:double,later:double>"


def same_keys(left: DataFrame, right: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """Equi-join that also matches null keys and keeps the left names."""
    renamed = right.select(*(F.col(n).alias(f"_k_{n}") for n in names), *(c for c in right.columns if c not in names))
    joined = left.join(renamed, [F.col(n).eqNullSafe(F.col(f"_k_{n}")) for n in names], how)
    return joined.drop(*(f"_k_{n}" for n in names))


def next_moments(moments: DataFrame, keys: Sequence[str], seconds: float, width: float) -> DataFrame:
    """keys, _at and _to: the first moment at least ``seconds`` after ``_at``; moments without one are left out.

    ``moments`` are distinct in keys and ``_at``. Seen backwards in time, the wanted moment is the last one before the probe
    that stands ``seconds`` behind a moment. A probe stands a few roundings early and takes the moment after the one
    found where that is too near, so the subtraction itself decides. Order buckets of ``width`` seconds keep a
    long key out of one task.
    """
    keys = list(keys)
    back = moments.withColumn("_back", -F.col("_at"))
    known = with_previous(back, keys, ["_back"], {"_later": "_at"}, width)
    event = F.struct(F.col("_at").alias("at"), F.col("_later").alias("later")).cast(_MOMENT)
    early = (F.abs("_at") + F.lit(seconds)) * 1e-15
    both = known.select(*keys, "_back", F.lit(0).alias("_kind"), "_at", event.alias("_event")).unionByName(
        back.select(*keys, (-(F.col("_at") + F.lit(seconds) - early)).alias("_back"), F.lit(1).alias("_kind"), "_at",
                    F.lit(None).cast(_MOMENT).alias("_event")))
    found = with_last_value(both, keys, ["_back", "_kind"], {"_found": F.col("_event")}, width).where("_kind = 1")
    first, second = F.col("_found.at"), F.col("_found.later")
    to = F.when(first - F.col("_at") >= F.lit(seconds), first).when(second - F.col("_at") >= F.lit(seconds), second)
    return found.select(*keys, "_at", to.alias("_to")).where("_to IS NOT NULL")


def kept_moments(moments: DataFrame, keys: Sequence[str], seconds: float, width: float) -> DataFrame:
    """keys and _at of the moments on each key's chain: the first, the next one ``seconds`` later, and so on."""
    keys = list(keys)
    at = [*keys, "_at"]
    first = moments.groupBy(*keys).agg(F.min("_at").alias("_at"))
    rounds = [materialise(next_moments(moments, keys, seconds, width), "pointers")]
    while rounds[-1].take(1):
        now = rounds[-1]
        reached = now.select(*keys, F.col("_to").alias("_at")).unionByName(first).distinct()
        ahead = now.select(*keys, F.col("_at").alias("_to"), F.col("_to").alias("_further"))
        twice = same_keys(same_keys(now, reached, at, "left_semi"), ahead, [*keys, "_to"], "inner")
        rounds.append(materialise(twice.select(*at, F.col("_further").alias("_to")), "pointers"))
    kept = first
    for pointers in reversed(rounds[:-1]):
        kept = kept.unionByName(same_keys(pointers, kept, at, "left_semi").select(*keys, F.col("_to").alias("_at")))
    return kept
