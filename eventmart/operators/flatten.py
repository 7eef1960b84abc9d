"""Projection of nested event structs into one flat, wide row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventmart.functions.columns import event_date
from eventmart.schema import EVENT_FLAT_FIELDS


def flatten(
    df: DataFrame,
    fields: Sequence[tuple[str, str]] = EVENT_FLAT_FIELDS,
    ts_col: str | None = "created_at",
    date_col: str | None = "event_date",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Promote nested fields to top-level columns, one Project node.

    ``fields`` lists (source path, output name). When ``date_col`` is given the
    UTC date of the output column ``ts_col`` is added right after it, so the
    partition value exists before the write and reads can prune on it. The
    same function serves batch and streaming inputs. ``keep`` passes extra
    top-level columns through unchanged (e.g. the corrupt-record column).
    """
    cols = []
    for path, alias in fields:
        cols.append(F.col(path).alias(alias))
        if date_col and alias == ts_col:
            cols.append(event_date(F.col(path)).alias(date_col))
    cols += [F.col(c) for c in keep if c in df.columns]
    return df.select(*cols)


def parse_json_column(df: DataFrame, column: str, schema: StructType | str) -> DataFrame:
    """Replace a JSON text column by its parsed struct (malformed -> null fields)."""
    return df.withColumn(column, F.from_json(F.col(column), schema))
