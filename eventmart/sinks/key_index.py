"""Key index: which keys a table holds, asked without reading all of them.

Keys lie in *runs*. A run is a Parquet table of (bucket, keys, partition) sorted
by bucket, about ``bucket_rows`` keys to a bucket, with a Bloom filter per bucket
beside it: 32,768 bits, four of them set per key, built with Spark's bitmap
aggregate. A batch asks the filters first; only buckets that hold one of its keys
(or, about once in 400 keys, seem to) are then read, as ranges of the sorted files
that Parquet's page statistics skip to. So the key rows read for a batch grow with
the batch, not with the table. The keys of a small batch are sent to every task;
those of a large one are dealt out and sorted, in one join with the filters and one
with the runs, however many these are, so that no task and no driver holds them all.

Every merge adds one run with the keys it wrote; when there would be more than
``max_runs``, the smaller half of them becomes one run with the new keys. A table's
commit record names the runs that are valid with it, so rows and index change
together: a run whose commit did not happen is never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from eventmart.session import run_together

BUCKET_ROWS = 2048
MAX_RUNS = 8
#: bits of a filter (the size of Spark's bitmaps), and how many of them a key sets
FILTER_BITS, PROBES = 32_768, 4
#: keys in a file of a run
FILE_ROWS = 1 << 20
#: keys whose filters one task builds
FILTER_ROWS = 1 << 18
#: buckets that a lookup reads as ranges; beyond, it reads the runs that are hit
MAX_RANGES = 256
#: rows of a batch (a row per key and run that is asked) that a lookup sends whole to every task
BROADCAST_ROWS = 1 << 17

KEY_HASH, BUCKET, PART = "_hash", "_bucket", "_part"


def _probes(key_hash: Column) -> Column:
    """The positions that a key sets: 15 bits each of a second hash."""
    second = F.xxhash64(key_hash, F.lit(7))
    return F.array(*[F.shiftrightunsigned(second, 15 * i).bitwiseAND(F.lit(FILTER_BITS - 1)) for i in range(PROBES)])


def _is_set(bits: str, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (position % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def _ranges(buckets: list[int]) -> list[tuple[int, int]]:
    """Ascending buckets as (first, last) of their runs without a gap."""
    out: list[tuple[int, int]] = []
    for b in sorted(buckets):
        if out and b == out[-1][1] + 1:
            out[-1] = (out[-1][0], b)
        else:
            out.append((b, b))
    return out


def _any_of(conditions: list[Column]) -> Column:
    """Their disjunction as a balanced tree (a long chain would be a deep one)."""
    while len(conditions) > 1:
        conditions = [reduce(Column.__or__, conditions[i:i + 2]) for i in range(0, len(conditions), 2)]
    return conditions[0]


def _side(rows: DataFrame, n_rows: int) -> DataFrame:
    """rows as one side of a join: whole to every task if few, else dealt out and sorted.

    Their number is known. Left to Spark's estimate, which takes the size of the files
    below and sees neither their compression nor the rows that an explode adds, millions
    of keys are broadcast.
    """
    return F.broadcast(rows) if n_rows <= BROADCAST_ROWS else rows.hint("merge")


class KeyIndex:
    """The runs of one table's keys under ``root``.

    A run is described by ``{"id", "buckets", "rows"}``; the caller keeps the
    list of valid runs. ``part_col`` is stored with every key, so that a lookup
    tells in which partition it is (or was, before an upsert moved it).
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], schema: StructType, part_col: str | None = None,
                 bucket_rows: int = BUCKET_ROWS, max_runs: int = MAX_RUNS):
        self.spark, self.root, self.keys, self.part_col = spark, root.rstrip("/"), list(keys), part_col
        self.bucket_rows, self.max_runs = bucket_rows, max_runs
        self.types = {k: schema[k].dataType for k in self.keys}
        self.row_schema = StructType([
            StructField(BUCKET, LongType()), *[StructField(k, t) for k, t in self.types.items()],
            StructField(PART, schema[part_col].dataType if part_col else StringType())])

    def _hashed(self, df: DataFrame) -> DataFrame:
        """The keys, in the table's types, with their hash."""
        keys = [F.col(k).cast(t).alias(k) for k, t in self.types.items()]
        rest = [F.col(c) for c in (PART,) if c in df.columns]
        return df.select(*keys, *rest).withColumn(KEY_HASH, F.xxhash64(*self.keys))

    def _path(self, run: dict, kind: str) -> str:
        return f"{self.root}/{kind}/run={run['id']}"

    def _rows(self, runs: list[dict]) -> DataFrame:
        """(bucket, keys, partition) of some runs, as one scan."""
        return self.spark.read.schema(self.row_schema).parquet(*[self._path(r, "keys") for r in runs])

    def _filters(self, runs: list[dict]) -> DataFrame:
        """(run, bucket, bits) of some runs, as one scan."""
        reader = self.spark.read.schema(f"{BUCKET} long, bits binary, run string").option("basePath", f"{self.root}/filter")
        return reader.parquet(*[self._path(r, "filter") for r in runs])

    def add(self, rows: DataFrame, n_rows: int, runs: list[dict]) -> list[dict]:
        """Write the keys (and partition) of rows as a run; the runs that are valid with it."""
        if not n_rows:
            return runs
        part = F.col(self.part_col) if self.part_col else F.lit(None).cast("string")
        rows = self._hashed(rows.withColumn(PART, part))
        kept = runs
        if len(runs) >= self.max_runs:
            by_size = sorted(runs, key=lambda r: r["rows"])
            merged, kept = by_size[:max(1, self.max_runs // 2)], by_size[max(1, self.max_runs // 2):]
            for run in merged:
                rows = rows.unionByName(self._hashed(self._rows([run])))
                n_rows += run["rows"]
        buckets = 1 << max(0, (-(-n_rows // self.bucket_rows) - 1).bit_length())
        run = {"id": uuid.uuid4().hex[:16], "buckets": buckets, "rows": n_rows}
        bucket = F.pmod(KEY_HASH, F.lit(buckets).cast("long")).alias(BUCKET)
        dealt = rows.select(bucket, *self.keys, PART)
        files = -(-n_rows // FILE_ROWS)
        dealt = dealt.coalesce(1) if files == 1 else dealt.repartitionByRange(files, BUCKET)
        dealt = dealt.sortWithinPartitions(BUCKET).write.option("parquet.page.row.count.limit", max(1, self.bucket_rows // 2))
        # the bitmap aggregate sorts its positions, four to a key: dealt out by bucket first, a task has few
        filters = rows.select(bucket, KEY_HASH).repartition(-(-n_rows // FILTER_ROWS), BUCKET)
        filters = filters.select(BUCKET, F.explode(_probes(F.col(KEY_HASH))).alias("position")).groupBy(BUCKET).agg(
            F.bitmap_construct_agg("position").alias("bits"))
        run_together(self.spark, [lambda: dealt.parquet(self._path(run, "keys")), lambda: filters.write.parquet(self._path(run, "filter"))])
        return [*kept, run]

    def _hit_buckets(self, hashed: DataFrame, runs: list[dict], n_rows: int) -> DataFrame:
        """(run, bucket) whose filter lets a key of the batch pass."""
        asked = F.explode(F.array(*[F.struct(F.lit(r["id"]).alias("run"), F.lit(r["buckets"]).cast("long").alias("buckets")) for r in runs]))
        asked = hashed.select(KEY_HASH, asked.alias("r")).select(
            F.col("r.run").alias("run"), F.pmod(KEY_HASH, F.col("r.buckets")).alias(BUCKET), KEY_HASH)
        probes = _probes(F.col(KEY_HASH))
        passes = reduce(Column.__and__, [_is_set("bits", probes[i]) for i in range(PROBES)])
        asked = _side(asked, n_rows * len(runs))
        return asked.join(self._filters(runs), ["run", BUCKET]).filter(passes).select("run", BUCKET).distinct()

    def _hits(self, hashed: DataFrame, runs: list[dict], n_rows: int) -> dict[str, list[int] | None]:
        """Run id -> its buckets whose filter lets a key of the batch pass; None: too many to name."""
        found = self._hit_buckets(hashed, runs, n_rows).limit(MAX_RANGES + 1).collect()
        if len(found) > MAX_RANGES:
            return {r["id"]: None for r in runs}
        out: dict[str, list[int] | None] = {}
        for run, bucket in found:
            out.setdefault(run, []).append(bucket)
        return out

    def matched(self, batch: DataFrame, runs: list[dict], n_rows: int | None = None) -> DataFrame | None:
        """(keys, partition) of the index rows whose key is in the batch; None if there is none for certain.

        A key can come more than once (in the partitions an upsert moved it through).
        ``n_rows``: the rows of the batch, counted if not given.
        """
        if not runs:
            return None
        if n_rows is None:
            n_rows = batch.count()
        hashed = self._hashed(batch)
        hits = self._hits(hashed, runs, n_rows)
        if not hits:
            return None
        # a merge join with a union would be a join with each run, which one task may run all, each sorting the batch's keys
        large = n_rows > BROADCAST_ROWS
        asked = [runs] if large else [[r] for r in runs]
        held = reduce(DataFrame.unionByName, [self._in_buckets(hit, hits) for rs in asked if (hit := [r for r in rs if r["id"] in hits])])
        found = held.join(_side(hashed.select(*self.keys), n_rows), self.keys, "left_semi")
        # as many rows as the batch has, perhaps, so a join with them is one of large sides too
        return found.hint("merge") if large else found

    def _in_buckets(self, runs: list[dict], hits: dict[str, list[int] | None]) -> DataFrame:
        """(keys, partition) of some runs in the buckets that are hit in any of them, as one scan."""
        rows, named = self._rows(runs), [hits[r["id"]] for r in runs]
        if None not in named:
            rows = rows.filter(_any_of([F.col(BUCKET).between(a, b) for a, b in _ranges(list(set().union(*named)))]))
        return rows.select(*self.keys, PART)

    def drop(self, runs: list[dict]) -> None:
        """Delete runs that no commit names any more."""
        from eventmart.sinks.table import delete_path
        for run in runs:
            for kind in ("keys", "filter"):
                delete_path(self.spark, self._path(run, kind))
