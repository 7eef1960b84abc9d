"""Partitioned table that merges and replaces into: plain Parquet, changed by
whole commits, for environments without a transactional table format.

Layout under ``root``::

    data/_version=N/_attempt=ID/<part>=V/part-*.parquet   rows written by version N
    commits/<N, 20 digits>.json                            one commit record for version N

A writer puts its rows into an attempt folder of its own, then writes the commit
record, which names that folder, to a temporary file and renames it to its final
name; the rename fails if the name is taken. So a version is visible completely
or not at all, two writers racing for it cannot both commit, and the loser's
rows are in a folder nobody reads. A commit records which partition values it
*replaces* (or that it replaces the whole table); a row of version v in
partition p is visible iff no committed w > v replaced p. That rule refers only
to partition columns, so Spark evaluates it as a partition filter: the folders
of committed versions are listed, and the files of superseded partitions are
never read.

With ``bucket_by`` the files are bucketed and sorted on the merge key (Spark's
own bucketing; the table is registered over its files while it is planned), so an
upsert joins the rows it rewrites with its batch, and writes them back, without
exchanging them.

Merges ask a key index (``sinks.key_index``) which of the batch's keys the table
holds, and in which partitions; commits name the index runs valid with them.

Partition values are kept as Spark writes them in paths; an empty string and
null are the same partition. Streaming writers pass (query id, batch id) so a
replayed micro-batch that was already committed is skipped (exactly-once
effect on top of at-least-once delivery).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from eventmart.operators import merge as M
from eventmart.sinks.key_index import PART, KeyIndex

VERSION_COL = "_version"
ATTEMPT_COL = "_attempt"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop_fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def list_subdirs(spark: SparkSession, path: str) -> list[str]:
    """Sorted child folders of ``path`` (one listing call; files are skipped)."""
    fs, p = _hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().toString() for st in fs.listStatus(p)
                  if st.isDirectory() and not st.getPath().getName().startswith(("_", ".")))


def written_partitions(spark: SparkSession, path: str) -> tuple[list[str], bool]:
    """The partition values a write made folders for, and whether null is one of them."""
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    values = [p.rstrip("/").rsplit("/", 1)[1].split("=", 1)[1] for p in list_subdirs(spark, path)]
    return sorted(unescape(v) for v in values if v != NULL_PARTITION), NULL_PARTITION in values


class CommitConflict(RuntimeError):
    pass


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file whole or not at all; fails if it already exists."""
    fs, p = _hadoop_fs(spark, path)
    jvm = spark.sparkContext._jvm
    aside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        files.rename(aside, p, spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
    except Py4JJavaError as exc:
        fs.delete(aside, False)
        if fs.exists(p):
            raise CommitConflict(f"{path} already exists") from exc
        raise


def read_texts(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """Contents of the small files in ``folder`` ending with ``suffix``."""
    fs, p = _hadoop_fs(spark, folder)
    if not fs.exists(p):
        return []
    jvm = spark.sparkContext._jvm
    out = []
    for status in fs.listStatus(p):
        path = status.getPath()
        if not path.getName().endswith(suffix):
            continue
        stream = fs.open(path)
        try:
            out.append(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
    return out


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]):
    """The session's settings with some replaced while a plan is made or run."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _encode_commit(row: dict) -> str:
    out = dict(row)
    out["committed_at"] = row["committed_at"].isoformat()
    return json.dumps(out)


def _decode_commit(text: str) -> dict:
    row = json.loads(text)
    row["committed_at"] = dt.datetime.fromisoformat(row["committed_at"])
    return row


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, partition_by: str | None = None,
                 rebalance: bool = True, bucket_by: tuple[Sequence[str], int] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.data_root = f"{self.root}/data"
        self.commit_root = f"{self.root}/commits"
        self._partition_by = partition_by
        self._bucket_by = (list(bucket_by[0]), bucket_by[1]) if bucket_by else None
        self.rebalance = rebalance
        self._commit_cache: list[dict] | None = None
        # test hook: fault(version, stage) is called after the data of a
        # version is written ("data") and after its commit row is ("commit"),
        # to simulate a crash at either point
        self.fault: Callable[[int, str], None] | None = None

    # ------------------------------------------------------------------ metadata
    def commits(self, refresh: bool = False) -> list[dict]:
        """Committed versions in order (metadata only: one small row each).

        Read once per instance and then kept up to date by this instance's
        own commits (single writer per table); ``refresh=True`` re-reads.
        """
        if self._commit_cache is None or refresh:
            self._commit_cache = self._read_commits()
        return list(self._commit_cache)

    def _read_commits(self) -> list[dict]:
        rows = [_decode_commit(t) for t in read_texts(self.spark, self.commit_root, ".json")]
        return sorted(rows, key=lambda r: r["version"])

    def exists(self) -> bool:
        return bool(self.commits())

    def version(self) -> int | None:
        c = self.commits()
        return c[-1]["version"] if c else None

    @property
    def partition_by(self) -> str | None:
        if self._partition_by is None:
            c = self.commits()
            if c and c[-1]["partition_by"]:
                self._partition_by = c[-1]["partition_by"]
        return self._partition_by

    @property
    def bucket_by(self) -> tuple[list[str], int] | None:
        """Keys and number of buckets; the first commit decides."""
        c = self.commits()
        found = c[-1].get("bucket_by") if c else self._bucket_by
        return (found[0], found[1]) if found else None

    def schema(self) -> StructType | None:
        c = self.commits()
        return StructType.fromJson(json.loads(c[-1]["schema_json"])) if c else None

    def is_committed(self, query_id: str, batch_id: int) -> bool:
        return any(c["query_id"] == query_id and c["batch_id"] == batch_id for c in self.commits())

    # --------------------------------------------------------------------- reads
    def read(self) -> DataFrame:
        """The visible rows."""
        commits = self.commits()
        if not commits:
            raise FileNotFoundError(f"no committed version under {self.root}")
        # versions before the last whole-table replacement can hold no visible
        # row: they are not even listed
        base = max([c["version"] for c in commits if c["replaces_all"]], default=0)
        return self._rows([c for c in commits if c["version"] >= base])

    def read_after(self, version: int | None) -> DataFrame:
        """The rows that commits after ``version`` wrote (None: all commits). These are the
        rows that were added since, when the commits only inserted."""
        return self._rows([c for c in self.commits() if version is None or c["version"] > version])

    def only_added_since(self, version: int | None) -> bool:
        """Whether the commits after ``version`` took no row away."""
        return not any(c["replaces_all"] or c["replaced_parts"] or c["replaces_null"] for c in self.commits()
                       if version is None or c["version"] > version)

    def _rows(self, commits: list[dict]) -> DataFrame:
        """Visible rows of some commits."""
        every = self.commits()
        schema = StructType.fromJson(json.loads(every[-1]["schema_json"]))
        with_rows = [c for c in commits if c["num_output_rows"]]
        if not with_rows:
            return self.spark.createDataFrame([], schema)
        read_schema = StructType([*schema.fields, StructField(VERSION_COL, IntegerType()),
                                  StructField(ATTEMPT_COL, StringType())])
        paths = [self._attempt_path(c["version"], c["attempt"]) for c in with_rows]
        df = (self.spark.read.schema(read_schema).option("basePath", self.data_root)
              .parquet(*paths))
        return df.filter(self._visible(every, self.partition_by)).select(*schema.fieldNames())

    def _visible(self, upto: list[dict], part: str | None) -> Column:
        all_cut = max([c["version"] for c in upto if c["replaces_all"]], default=-1)
        v = F.col(VERSION_COL)
        if not part:
            return v >= F.lit(all_cut)
        cut: dict[str, int] = {}
        null_cut = all_cut
        for c in upto:
            for p in c["replaced_parts"] or []:
                cut[p] = max(cut.get(p, -1), c["version"])
            if c["replaces_null"]:
                null_cut = max(null_cut, c["version"])
        pc = F.col(part)
        if cut:
            m = F.create_map(*[x for k, val in sorted(cut.items()) for x in (F.lit(k), F.lit(val))])
            part_cut = F.coalesce(F.try_element_at(m, pc.cast("string")), F.lit(-1))
        else:
            part_cut = F.lit(-1)
        non_null = v >= F.greatest(F.lit(all_cut), part_cut)
        return F.when(pc.isNull(), v >= F.lit(null_cut)).otherwise(non_null)

    # -------------------------------------------------------------------- writes
    def _commit(self, df: DataFrame, operation: str, replaced: Sequence[str] = (),
                replaces_null: bool = False, replaces_all: bool = False, replaces_written: bool = False,
                query_id: str | None = None, batch_id: int | None = None,
                num_input_rows: int | None = None, known_rows: int | None = None,
                indexed: Callable[[DataFrame, int], dict] | None = None, in_place: DataFrame | None = None) -> int:
        """Write df as the next version.

        ``in_place``: more rows of it, which lie in the table's buckets already.

        ``replaces_written``: the partitions that df has rows in are replaced,
        read from the folders that its write made. ``indexed``: given the written
        rows and their number, the key index entry of the commit.
        """
        commits = self.commits()
        n = commits[-1]["version"] + 1 if commits else 0
        if path_exists(self.spark, self._commit_path(n)):
            # our cached log is stale (another writer committed n): never
            # overwrite a committed version's data; re-read and move on
            commits = self.commits(refresh=True)
            n = commits[-1]["version"] + 1
        part = self.partition_by
        schema = df.schema
        attempt = uuid.uuid4().hex[:16]
        path = self._attempt_path(n, attempt)
        self._write([(df, True)] if in_place is None else [(in_place, False), (df, True)], path)
        # counted from the files, which a task that ran twice has not doubled
        written = known_rows if known_rows is not None else self._count_files(path, schema)
        if replaces_written:
            replaced, replaces_null = written_partitions(self.spark, path)
        entry = indexed(self.spark.read.schema(schema).parquet(path), written) if indexed else None
        if self.fault is not None:
            self.fault(n, "data")
        row = {
            "version": n, "attempt": attempt,
            "committed_at": dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
            "operation": operation, "query_id": query_id, "batch_id": batch_id,
            "replaced_parts": list(replaced), "replaces_null": bool(replaces_null),
            "replaces_all": bool(replaces_all),
            "num_input_rows": num_input_rows if num_input_rows is not None else written,
            "num_output_rows": written, "schema_json": schema.json(), "partition_by": part,
            "bucket_by": self.bucket_by, "key_index": entry,
        }
        create_text(self.spark, self._commit_path(n), _encode_commit(row))
        self._commit_cache = commits + [row]
        if self.fault is not None:
            self.fault(n, "commit")
        return n

    def _write(self, parts: list[tuple[DataFrame, bool]], path: str) -> None:
        """Write rows to a folder; of a bucketed table, those of a part marked True are dealt to buckets first."""
        part, bucketed = self.partition_by, self.bucket_by
        if not bucketed:
            for df, _ in parts:
                # AQE-aware: balances file sizes per partition value and splits a
                # hot value over several tasks instead of one.
                w = (df.hint("rebalance", part) if part and self.rebalance else df).write
                (w.partitionBy(part) if part else w).mode("append").parquet(path)
            return
        keys, n = bucketed
        name = f"eventmart_{uuid.uuid4().hex}"
        try:
            for df, deal in parts:
                w = (df.repartition(n, *keys) if deal else df).write
                w = (w.partitionBy(part) if part else w).bucketBy(n, keys[0], *keys[1:]).sortBy(keys[0], *keys[1:])
                w.mode("append").format("parquet").option("path", path).saveAsTable(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")     # external: its files stay

    def _read_bucketed(self) -> DataFrame:
        """The visible rows as a scan that is partitioned by its buckets."""
        keys, n = self.bucket_by
        names = ", ".join(f"`{k}`" for k in keys)
        fields = [*self.schema().fields, StructField(VERSION_COL, IntegerType()), StructField(ATTEMPT_COL, StringType())]
        part = [VERSION_COL, ATTEMPT_COL, *([self.partition_by] if self.partition_by else [])]
        name = f"eventmart_{uuid.uuid4().hex}"
        with session_conf(self.spark, {"spark.sql.hive.manageFilesourcePartitions": "false"}):
            self.spark.sql(
                f"CREATE TABLE {name} ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in fields)}) USING parquet "
                f"OPTIONS (path '{self.data_root}') PARTITIONED BY ({', '.join(f'`{c}`' for c in part)}) "
                f"CLUSTERED BY ({names}) SORTED BY ({names}) INTO {n} BUCKETS")
            try:
                df = self.spark.table(name)
                df.schema  # noqa: B018 -- resolved while the name exists; the plan holds the files
            finally:
                self.spark.sql(f"DROP TABLE {name}")
        every = self.commits()
        attempts = [c["attempt"] for c in every if c["num_output_rows"]]
        return df.filter(F.col(ATTEMPT_COL).isin(attempts) & self._visible(every, self.partition_by)).select(*self.schema().fieldNames())

    def _commit_path(self, n: int) -> str:
        return f"{self.commit_root}/{n:020d}.json"

    def _attempt_path(self, n: int, attempt: str) -> str:
        return f"{self.data_root}/{VERSION_COL}={n}/{ATTEMPT_COL}={attempt}"

    def _count_files(self, path: str, schema: StructType) -> int:
        return self.spark.read.schema(schema).parquet(path).count() if path_exists(self.spark, path) else 0

    def create_if_missing(self, schema: StructType) -> bool:
        """Bootstrap an empty version 0 with the given schema; False if it exists."""
        if self.exists():
            return False
        self._commit(self.spark.createDataFrame([], schema), "CREATE", known_rows=0)
        return True

    def append(self, df: DataFrame, **meta) -> int:
        return self._commit(df, "WRITE", **meta)

    def overwrite(self, df: DataFrame, **meta) -> int:
        return self._commit(df, "OVERWRITE", replaces_all=True, **meta)

    def replace_partitions(self, df: DataFrame, **meta) -> int:
        """Overwrite exactly the partition values present in ``df``, which is evaluated once."""
        if not self.partition_by:
            return self.overwrite(df, **meta)
        return self._commit(df, "REPLACE", replaces_written=True, **meta)

    def replace_among(self, df: DataFrame, values: Sequence[str], **meta) -> int:
        """Overwrite the named partitions with df's rows of them, and add df's other rows to theirs."""
        return self._commit(df, "REPLACE", replaced=values, **meta)

    # ---------------------------------------------------------------- key index
    def key_index(self, keys: Sequence[str]) -> KeyIndex:
        return KeyIndex(self.spark, f"{self.root}/keys", keys, self.schema(), self.partition_by)

    def _index_runs(self, index: KeyIndex) -> list[dict]:
        """Runs that hold every key of the table (and perhaps some that it held before).

        Those of the last commit that names runs of these keys, and one more with
        the rows written since by commits without; all rows are read once where
        there is no such commit.
        """
        runs, after = [], 0
        for i, c in enumerate(self.commits()):
            if (c.get("key_index") or {}).get("keys") == index.keys:
                runs, after = c["key_index"]["runs"], i + 1
            elif c["replaces_all"] or c["replaced_parts"] or c["replaces_null"]:
                runs, after = [], 0     # keys may have left the table
        missing = [c for c in self.commits()[after:] if c["num_output_rows"]]
        if not missing:
            return runs
        rows = self._rows(missing)
        return index.add(rows, rows.count(), runs)

    def _with_index(self, index: KeyIndex, runs: list[dict], commit: Callable[[Callable], int],
                    rows: Callable[[DataFrame, int], tuple[DataFrame, int]] = lambda written, n: (written, n)) -> int:
        """Run commit with a function that adds its rows to the index; runs merged away are deleted after it."""
        named: dict = {}
        before = next((c["key_index"]["runs"] for c in reversed(self.commits()) if c.get("key_index")), [])

        def indexed(written: DataFrame, n: int) -> dict:
            named["runs"] = index.add(*rows(written, n), runs)
            return {"keys": index.keys, "runs": named["runs"]}

        version = commit(indexed)
        now = {r["id"] for r in named["runs"]}
        index.drop([r for r in [*before, *runs] if r["id"] not in now])
        return version

    def merge_insert(self, batch: DataFrame, keys: Sequence[str], batch_unique: bool = False, **meta) -> int | None:
        """Insert batch rows whose key the table lacks; matched keys are skipped.

        The key index is asked; the table itself is not read. ``batch`` is
        evaluated more than once, so it should be read from files.
        """
        if not self.exists():
            self.create_if_missing(batch.schema)
        keys = list(keys)
        index = self.key_index(keys)
        runs = self._index_runs(index)
        present = M.require_keys(batch, keys)
        new = present if batch_unique else present.dropDuplicates(keys)
        matched = index.matched(present, runs, meta.get("num_input_rows"))
        if matched is not None:
            new = new.join(matched.select(*keys), keys, "left_anti")
        new = new.select(*self.schema().fieldNames())
        return self._with_index(index, runs, lambda indexed: self._commit(new, "MERGE", indexed=indexed, **meta))

    def upsert(self, batch: DataFrame, keys: Sequence[str], **meta) -> int:
        """Matched keys get the batch row, others are inserted.

        The batch is staged once; its check, the match and the rewrite read the
        staged files. The key index names the partitions that hold a matched row:
        only these are read and rewritten, the batch's other rows are added. A
        table without partitions is rewritten whole.
        """
        keys = list(keys)
        stage = f"{self.root}/_staging/{uuid.uuid4().hex}"
        batch.write.parquet(stage)
        staged = self.spark.read.schema(batch.schema).parquet(stage)
        try:
            n = M.check_upsert_batch(staged, keys)
            if not self.exists():
                return self._commit(staged, "MERGE", **meta)
            target = self.read()
            staged = staged.select(*target.columns)
            part = self.partition_by
            if not part:
                return self._commit(M.upsert(target, staged, keys, check_batch=False), "MERGE", replaces_all=True, **meta)
            index = self.key_index(keys)
            runs = self._index_runs(index)
            matched = index.matched(staged, runs, n)
            values, has_null, merged, kept = [], False, staged, None
            if matched is not None:
                values, has_null = M.partition_values(matched.select(F.col(PART).alias(part)), part)
                by_bucket = bool(self.bucket_by) and self.bucket_by[0] == keys
                affected = (self._read_bucketed() if by_bucket else target).filter(M.touched_predicate(part, values, has_null))
                rest = affected.join(staged.select(*keys), keys, "left_anti").select(*target.columns)
                if by_bucket:
                    kept = rest
                else:
                    merged = rest.unionByName(staged)
            # a bucketed scan stays one even where the batch is broadcast: its rows go back to their buckets
            with session_conf(self.spark, {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}):
                return self._with_index(
                    index, runs, lambda indexed: self._commit(merged, "MERGE", replaced=values, replaces_null=has_null, indexed=indexed,
                                                              in_place=kept, **meta),
                    rows=lambda written, _: (staged, n))
        finally:
            delete_path(self.spark, stage)

    def delete(self, predicate: Column, **meta) -> int:
        """Remove rows matching ``predicate`` (null = keep), as a new version."""
        target = self.read()
        part = self.partition_by
        if not part:
            return self._commit(M.delete_where(target, predicate), "DELETE", replaces_all=True, **meta)
        hit = target.filter(F.coalesce(predicate, F.lit(False)))
        values, has_null = M.partition_values(hit, part)
        affected = target.filter(M.touched_predicate(part, values, has_null))
        return self._commit(M.delete_where(affected, predicate), "DELETE",
                            replaced=values, replaces_null=has_null, **meta)
