"""Aggregates kept up to date by deltas instead of being rebuilt.

A state table holds one row per key with measures that merge: sums of counts,
minima, maxima, and the greatest of an ordered struct (the latest row). A delta
-- whatever rows arrived, late and repeated ones included -- is aggregated by
itself and merged with the keys' rows: in a partitioned table only the partitions
that the delta touches are read and rewritten. An exact distinct count is a
count of the keys of a finer state, which has a row per (group, value).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.operators import merge as M
from eventmart.session import scratch_path
from eventmart.sinks.table import VersionedTable, delete_path

MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


class MergedState:
    """``measures``: name -> (aggregate over a delta's rows, how two of them merge: sum, min or max)."""

    def __init__(self, table: VersionedTable, keys: Sequence[str], measures: Mapping[str, tuple[Column, str]]):
        self.table, self.keys, self.measures = table, list(keys), dict(measures)
        if table.partition_by and table.partition_by not in self.keys:
            raise ValueError(f"{table.partition_by} must be one of the keys {self.keys}")

    def _of(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[agg.alias(name) for name, (agg, _) in self.measures.items()])

    def merged(self, parts: DataFrame) -> DataFrame:
        """Rows of the state's form, merged to one per key."""
        merges = []
        for name, (_, how) in self.measures.items():
            value = MERGE[how](name)
            merges.append((value.cast(parts.schema[name].dataType) if how == "sum" else value).alias(name))
        return parts.groupBy(*self.keys).agg(*merges)

    def rebuild(self, rows: DataFrame, **tag) -> None:
        """The state of exactly these rows."""
        self.table.overwrite(self._of(rows), **tag)

    def update(self, delta: DataFrame, **tag) -> bool:
        """Merge a delta. With ``query_id`` and ``batch_id`` a delta that was merged before is skipped (False)."""
        if tag and self.table.is_committed(**tag):
            return False
        if not self.table.exists():
            self.table.append(self._of(delta), **tag)
            return True
        spark, part = self.table.spark, self.table.partition_by
        if not part:
            self.table.overwrite(self.merged(self.table.read().unionByName(self._of(delta))), **tag)
            return True
        # staged: its partitions select what of the state is read, and the merge reads it again
        path = scratch_path(spark, "state-delta")
        of_delta = self._of(delta)
        of_delta.write.parquet(path)
        staged = spark.read.schema(of_delta.schema).parquet(path)
        touched = M.touched_predicate(part, *M.partition_values(staged, part))
        self.table.replace_partitions(self.merged(self.table.read().filter(touched).unionByName(staged)), **tag)
        delete_path(spark, path)
        return True

    def follow(self, source: VersionedTable, rows: Callable[[DataFrame], DataFrame] = lambda df: df) -> bool:
        """Merge what ``source`` got since this state last followed it; rebuild where rows were taken away.

        The state's commits say up to which version of the source they go, so a
        crash between the source and its states loses and doubles nothing.
        """
        tag = {"query_id": source.root, "batch_id": source.version()}
        seen = max([c["batch_id"] for c in self.table.commits() if c["query_id"] == source.root], default=None)
        if seen == source.version():
            return False
        if self.table.exists() and (seen is None or not source.only_added_since(seen)):
            self.rebuild(rows(source.read()), **tag)
            return True
        return self.update(rows(source.read() if seen is None else source.read_after(seen)), **tag)

    def read(self) -> DataFrame:
        return self.table.read()
