"""Materialisation of models: view or incremental merge."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from eventmart.operators.incremental import high_water_mark
from eventmart.sinks.table import VersionedTable


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """Staging / intermediate layers: a named temp view, nothing is stored."""
    df.createOrReplaceTempView(name)
    return df


def materialize_incremental(build: Callable[[object], DataFrame], table: VersionedTable,
                            keys: Sequence[str], mark_col: str) -> int:
    """Incremental model with a merge on ``keys``.

    First build (no table yet): create-as-select of ``build(None)``, which
    must itself enforce the grain. Later builds: ``build(mark)`` with the
    high-water mark of ``mark_col`` over the table, upserted on the keys. An
    existing but empty table has a null mark and loads everything.
    """
    if not table.exists():
        return table.append(build(None))
    mark = high_water_mark(table.read(), mark_col)
    return table.upsert(build(mark), keys)

