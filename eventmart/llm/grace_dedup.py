"""Exact duplicates by Grace hash partitioning and open-addressing tables.

1. ``_records``: every row becomes a narrow record; within an Arrow batch equal
   contents are collapsed first, so that a text with many copies travels once per
   batch. One representative per content and batch carries the normalised content.
   The records are the spill files: a Parquet table under spark.checkpoint.dir.
2. ``_buckets``: representatives are partitioned by hash; buckets whose content
   exceeds ``table_bytes`` are partitioned again by another hash, and so on.
   Sizes come from the narrow columns, so content is exchanged only once, to
   the final buckets. A bucket that no hash can split holds copies of one
   content from very many batches; it is salted, collapsed per salt, and the
   few survivors go round again.
3. ``_merge_bucket``: one bucket at a time, an open-addressing table (linear probing
   over the digests) compares complete contents and merges counts and winners.
4. Each row takes its representative's answer; this join is dealt by
   (batch, representative), at most one batch of rows per key.

Equality is that of the text without ASCII white space. The row with the most
code points in its original text stays, then the smallest doc_id, then any one
of identical rows.

Defined cases: null texts count as empty and equal to blank ones; null doc_ids
rank last; repeated rows form one group of which one row stays; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventmart.llm.common import drop_stage, row_key, stage

TABLE_BYTES = 16 << 20
FAN_OUT = 16
MAX_LEVELS = 8
_SPACES = b" \t\n\v\f\r"

RECORD = ("doc_id long, row_key long, row int, text_sha256 string, batch long, rep int, hash long, "
          "content binary, n_bytes long, copies long, best_points long, best_id long, best_row int")


def sha256_hash(content: bytes) -> bytes:
    return hashlib.sha256(content).digest()


class OpenTable:
    """Open-addressing hash table from content to a dense number, by complete comparison."""

    def __init__(self, expected: int):
        self.mask = (1 << max(4, (2 * expected).bit_length())) - 1
        self.slots = [-1] * (self.mask + 1)
        self.contents: list[bytes] = []
        self.hashes: list[int] = []

    def number(self, hashed: int, content: bytes) -> int:
        """The number of content, a new one if it isn't in the table."""
        at = hashed & self.mask
        while (found := self.slots[at]) >= 0:
            if self.hashes[found] == hashed and self.contents[found] == content:
                return found
            at = (at + 1) & self.mask
        self.slots[at] = len(self.contents)
        self.contents.append(content)
        self.hashes.append(hashed)
        return len(self.contents) - 1


def _first(points: int, doc_id: int | None, row: int) -> tuple:
    """Sort key of the row that stays: most code points, smallest id (null last), first row."""
    return (-points, doc_id is None, doc_id or 0, row)


def _records(batches: Iterator[pa.RecordBatch], hash_of: Callable[[bytes], bytes]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        name = int.from_bytes(os.urandom(8), "little", signed=True)  # committed files fix it; a lost task draws anew
        texts = batch["text"].to_pylist()
        ids = batch["doc_id"].to_pylist()
        table = OpenTable(len(texts))
        shas, rep, hashes = [], [], []
        first: list[int] = []       # the row that carries each content
        best: list[tuple] = []
        copies: list[int] = []
        for row, text in enumerate(texts):
            content = (text or "").encode("utf-8", "surrogatepass").translate(None, _SPACES)
            key = hash_of(content)
            hashed = int.from_bytes(key[:8], "little", signed=True)
            at = table.number(hashed, content)
            rank = _first(len(text or ""), ids[row], row)
            if at == len(first):
                first.append(row)
                best.append(rank)
                copies.append(0)
                shas.append(hashlib.sha256(content).hexdigest())
            copies[at] += 1
            best[at] = min(best[at], rank)
            rep.append(at)
            hashes.append(hashed)
        carried = [None] * len(texts)
        for at, row in enumerate(first):
            carried[row] = at
        pick = lambda values: [None if at is None else values[at] for at in carried]
        content = pick(table.contents)
        yield pa.RecordBatch.from_arrays([
            batch["doc_id"], batch["row_key"], pa.array(range(len(texts)), pa.int32()), pa.array([shas[at] for at in rep]),
            pa.array([name] * len(texts), pa.int64()), pa.array(rep, pa.int32()), pa.array(hashes, pa.int64()),
            pa.array(content, pa.binary()), pa.array([None if c is None else len(c) for c in content], pa.int64()),
            pa.array(pick(copies), pa.int64()), pa.array(pick([-b[0] for b in best]), pa.int64()),
            pa.array(pick([None if b[1] else b[2] for b in best]), pa.int64()), pa.array(pick([b[3] for b in best]), pa.int32()),
        ], ["doc_id", "row_key", "row", "text_sha256", "batch", "rep", "hash", "content", "n_bytes", "copies",
            "best_points", "best_id", "best_row"])


CONTENT = ["batch", "rep", "hash", "content", "n_bytes", "copies", "best_points", "best_id", "best_batch", "best_row"]
MERGED = ("batch long, rep int, to_batch long, to_rep int, survives boolean, hash long, content binary, n_bytes long, "
          "copies long, best_points long, best_id long, best_batch long, best_row int")


def _merge_bucket(table: pa.Table) -> pa.Table:
    """A row per representative: the first one of equal content in this bucket, and on that one the merged group."""
    columns = {c: table[c].to_pylist() for c in CONTENT}
    found = OpenTable(table.num_rows)
    first: list[int] = []
    copies: list[int] = []
    best: list[tuple] = []
    group = []
    for row in range(table.num_rows):
        at = found.number(columns["hash"][row], columns["content"][row])
        rank = (*_first(columns["best_points"][row], columns["best_id"][row], columns["best_batch"][row]), columns["best_row"][row])
        if at == len(first):
            first.append(row)
            copies.append(0)
            best.append(rank)
        copies[at] += columns["copies"][row]
        best[at] = min(best[at], rank)
        group.append(at)
    head = [first[at] for at in group]
    survives = [head[row] == row for row in range(len(group))]
    only = lambda values: [v if s else None for v, s in zip(values, survives, strict=True)]
    return pa.table({
        "batch": table["batch"], "rep": table["rep"],
        "to_batch": pa.array([columns["batch"][h] for h in head], pa.int64()),
        "to_rep": pa.array([columns["rep"][h] for h in head], pa.int32()),
        "survives": pa.array(survives), "hash": table["hash"],
        "content": pa.array(only(columns["content"]), pa.binary()), "n_bytes": table["n_bytes"],
        "copies": pa.array([copies[at] for at in group], pa.int64()),
        "best_points": pa.array([-best[at][0] for at in group], pa.int64()),
        "best_id": pa.array([None if best[at][1] else best[at][2] for at in group], pa.int64()),
        "best_batch": pa.array([best[at][3] for at in group], pa.int64()),
        "best_row": pa.array([best[at][4] for at in group], pa.int32())})


def _buckets(reps: DataFrame, table_bytes: int, fan_out: int, max_levels: int) -> tuple[DataFrame, bool]:
    """reps with the column bucket (a string path of hash parts), and whether some had to be salted."""
    spark = reps.sparkSession
    total = reps.agg(F.sum("n_bytes")).first()[0] or 0
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")) * 4, -(-2 * total // table_bytes))
    reps = reps.withColumn("bucket", F.pmod(F.xxhash64("hash", F.lit(0)), F.lit(width)).cast("string"))
    for level in range(1, max_levels + 2):
        sizes = reps.groupBy("bucket").agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n"))
        # an oversized bucket is a share of all content that grows with it: at most total / table_bytes of them
        large, path = stage(sizes.filter((F.col("bytes") > table_bytes) & (F.col("n") > 1)), "grace-oversized")
        if large.isEmpty():
            drop_stage(spark, path)
            return reps, False
        joined = reps.join(large, "bucket", "left")
        if level > max_levels:  # hashes don't split it: many copies of few contents
            part = F.pmod(F.xxhash64("batch", "rep"), F.ceil(F.col("bytes") / table_bytes).cast("long") + 1)
        else:
            part = F.pmod(F.xxhash64("hash", F.lit(level)), F.lit(fan_out))
        reps = joined.withColumn("bucket", F.when(F.col("bytes").isNotNull(), F.concat_ws(".", "bucket", part.cast("string")))
                                 .otherwise(F.col("bucket"))).drop("bytes", "n")
    return reps, True


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES,
                     fan_out: int = FAN_OUT, max_levels: int = MAX_LEVELS,
                     hash_of: Callable[[bytes], bytes] = sha256_hash) -> DataFrame:
    """(doc_id, row_key, keep_id, group_size, kept, text_sha256), a row per input row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(F.col(id_col), F.col(text_col)).alias("row_key"),
                       F.col(text_col).alias("text"))
    records, path = stage(rows.mapInArrow(lambda b: _records(b, hash_of), RECORD), "grace-records")
    reps = records.filter(F.col("copies").isNotNull()).withColumn("best_batch", F.col("batch")).select(*CONTENT)
    answers: DataFrame | None = None
    paths = [path]
    while True:
        dealt, salted = _buckets(reps, table_bytes, fan_out, max_levels)
        merged = dealt.groupBy("bucket").applyInArrow(_merge_bucket, MERGED)
        if not salted:  # groups are whole: contents aren't needed any more
            merged = merged.drop("content")
        merged, path = stage(merged, "grace-merged")
        paths.append(path)
        links = merged.select("batch", "rep", "to_batch", "to_rep")
        if answers is None:
            answers = links
        else:  # a representative that gave way in an earlier round follows its survivor
            older = answers.withColumnsRenamed({"to_batch": "via_batch", "to_rep": "via_rep"})
            links = links.withColumnsRenamed({"batch": "via_batch", "rep": "via_rep"})
            answers = older.join(links, ["via_batch", "via_rep"]).drop("via_batch", "via_rep")
        groups = merged.filter("survives")
        if not salted:
            break
        reps = groups.select(*CONTENT)
        table_bytes *= 2  # single texts near the limit must meet in the end
    groups = groups.select(F.col("batch").alias("to_batch"), F.col("rep").alias("to_rep"), F.col("best_id").alias("keep_id"),
                           F.col("copies").alias("group_size"), "best_batch", "best_row")
    # staged, so that both joins exchange both sides anew and can split a group with very many batches
    answers, path = stage(answers, "grace-links")
    paths.append(path)
    answers, path = stage(answers.join(groups, ["to_batch", "to_rep"]).drop("to_batch", "to_rep"), "grace-answers")
    paths.append(path)
    narrow = records.select("doc_id", "row_key", "row", "text_sha256", "batch", "rep")
    out = narrow.join(answers, ["batch", "rep"]).select(
        "doc_id", "row_key", "keep_id", "group_size",
        ((F.col("batch") == F.col("best_batch")) & (F.col("row") == F.col("best_row"))).alias("kept"), "text_sha256")
    out, _ = stage(out, "grace-result")
    for path in paths:
        drop_stage(spark, path)
    return out
