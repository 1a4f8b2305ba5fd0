"""Batch scoring with a caller-supplied model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kerbwatch.session import ship_package


def score_batches(df: DataFrame, loader: Callable[[], object],
                  score: Callable[[object, pd.DataFrame], pd.DataFrame], schema: str,
                  error_column: str = "score_error") -> DataFrame:
    """Score rows in Arrow batches: one model per task, no per-row call.

    ``score(model, batch)`` returns one output row per input row. When a batch fails its rows are tried
    one by one; the failing ones get null outputs (an array output becomes empty) and the error text.
    """
    ship_package(df.sparkSession)
    fields = T._parse_datatype_string(schema).fields
    out = T.StructType([*df.schema.fields, *fields, T.StructField(error_column, T.StringType())])
    names = [f.name for f in fields]
    blank = {f.name: [] if isinstance(f.dataType, T.ArrayType) else None for f in fields}

    def one_by_one(model, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for i in range(len(pdf)):
            row = pdf.iloc[i:i + 1]
            try:
                made = score(model, row)
                rows.append({**{n: made[n].iloc[0] for n in names}, error_column: None})
            except Exception as error:
                rows.append({**blank, error_column: f"{type(error).__name__}: {error}"})
        return pd.DataFrame(rows, columns=[*names, error_column], dtype=object)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for pdf in batches:
            if model is None:
                model = loader()
            pdf = pdf.reset_index(drop=True)
            try:
                made = score(model, pdf)[names].reset_index(drop=True).assign(**{error_column: None})
            except Exception:
                made = one_by_one(model, pdf)
            yield pd.concat([pdf, made], axis=1)

    return df.mapInPandas(run, out)
