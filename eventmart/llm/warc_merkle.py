"""Merkle fixity audit of WARC archives.

``archive`` turns pages into WARC records and lays them out in shards: a row per
record with its shard, offset, length and SHA-256. ``tree`` hashes the records of
each ordered offset range into a leaf, groups of ``fan_out`` leaves into a node,
and so on up to a root per shard. ``audit`` compares the roots of two replicas
and descends only into branches whose hashes differ, down to the records at fault.

Html never leaves the scan: digests and lengths are computed there. Records are
dealt to shards by digest, ``SHARD_RECORDS`` on average at most, and identical
records are one entry with a number of copies, so no id, host or page can make
a shard large.

Defined cases: null urls and html count as empty; null page_ids stand
last in their shard; repeated pages are records with copies; an empty replica
differs in every shard; equal replicas, or two empty ones, give no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventmart.llm.common import stage

#: records of a shard, on average at most
SHARD_RECORDS = 1024
#: bytes of an archive that a leaf covers
RANGE_BYTES = 1 << 14
FAN_OUT = 16


def record(page_id: Column, url: Column, html: Column) -> Column:
    """The WARC record of a page, as text."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def archive(pages: DataFrame, stored: Column | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            shard_records: int = SHARD_RECORDS) -> DataFrame:
    """(shard, offset, length, page_id, url, copies, record_sha256[, stored_sha256]), a row per distinct record.

    A shard's name is the first hex digits of its records' digests, as many as
    the number of records asks for; its records stand in order of page id, url
    and digest. ``stored``: the html that a copy holds for the same place, null
    where the copy lost the record.
    """
    page_id, url = F.col(id_col).cast("long"), F.col(url_col)
    text = record(page_id, url, F.col(html_col))
    columns = {"length": F.octet_length(text).cast("long"), "record_sha256": F.sha2(text, 256)}
    if stored is not None:
        columns["stored_sha256"] = F.when(stored.isNotNull(), F.sha2(record(page_id, url, stored), 256))
    rows = pages.select(page_id.alias("page_id"), F.coalesce(url, F.lit("")).alias("url"), *[v.alias(k) for k, v in columns.items()])
    rows, _ = stage(rows.groupBy(*rows.columns).agg(F.count("*").alias("copies")), "warc-records")
    digits, count = 0, rows.count()
    while count > shard_records * 16 ** digits:
        digits += 1
    rows = rows.withColumn("shard", F.concat(F.lit("warc-"), F.substring("record_sha256", 1, digits)))
    ahead = Window.partitionBy("shard").orderBy(F.asc_nulls_last("page_id"), "url", "record_sha256").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.col("length") * F.col("copies")).over(ahead), F.lit(0))
    out = rows.select("shard", offset.alias("offset"), "length", "page_id", "url", "copies", *[c for c in columns if c != "length"])
    return stage(out, "warc-index")[0]


def tree(records: DataFrame, range_bytes: int = RANGE_BYTES, fan_out: int = FAN_OUT, levels: int | None = None) -> list[DataFrame]:
    """The levels of the trees, leaves first: (shard, at, hash); the last level has a root per shard.

    A leaf covers offsets [at * range_bytes, (at + 1) * range_bytes), a node
    the fan_out nodes below it; its hash is over their places and hashes in order.
    """
    entry = F.struct("offset", F.concat_ws(":", "offset", "length", "copies", "record_sha256").alias("what"))
    leaves = (records.groupBy("shard", F.floor(F.col("offset") / range_bytes).cast("long").alias("at"))
              .agg(F.sha2(F.concat_ws(",", F.sort_array(F.collect_list(entry))["what"]), 256).alias("hash")))
    out = [stage(leaves, "merkle-leaves")[0]]
    for _ in range(depth(records, range_bytes, fan_out) if levels is None else levels):
        entry = F.struct("at", F.concat_ws(":", "at", "hash").alias("what"))
        out.append(out[-1].groupBy("shard", F.floor(F.col("at") / fan_out).cast("long").alias("up"))
                   .agg(F.sha2(F.concat_ws(",", F.sort_array(F.collect_list(entry))["what"]), 256).alias("hash"))
                   .withColumnRenamed("up", "at"))
    return out


def depth(records: DataFrame, range_bytes: int = RANGE_BYTES, fan_out: int = FAN_OUT) -> int:
    """Levels above the leaves until every shard has one root."""
    last = (records.agg(F.max("offset")).first()[0] or 0) // range_bytes
    levels = 0
    while last:
        last //= fan_out
        levels += 1
    return levels


def audit(first: DataFrame, second: DataFrame, range_bytes: int = RANGE_BYTES, fan_out: int = FAN_OUT) -> DataFrame:
    """(shard, offset, length, page_id, fault, first_sha256, second_sha256): where two replicas differ.

    fault is changed, missing (only the first has the record) or extra (only the second).
    """
    levels = max(depth(first, range_bytes, fan_out), depth(second, range_bytes, fan_out))
    pairs = list(zip(tree(first, range_bytes, fan_out, levels), tree(second, range_bytes, fan_out, levels), strict=True))
    suspects: DataFrame | None = None
    for a, b in reversed(pairs):
        if suspects is not None:  # only below nodes that differ
            below = [x.join(suspects, (x["shard"] == suspects["s"]) & (F.floor(x["at"] / fan_out) == suspects["p"]), "left_semi") for x in (a, b)]
            a, b = below
        differ = (a.withColumnRenamed("hash", "h1").join(b.withColumnRenamed("hash", "h2"), ["shard", "at"], "full")
                  .filter(~F.col("h1").eqNullSafe(F.col("h2"))))
        suspects, _ = stage(differ.select(F.col("shard").alias("s"), F.col("at").alias("p")), "merkle-suspects")
    at = lambda x: F.floor(x["offset"] / range_bytes)
    suspect = [x.join(suspects, (x["shard"] == suspects["s"]) & (at(x) == suspects["p"]), "left_semi") for x in (first, second)]
    named = [x.select("shard", "offset", *[F.col(c).alias(f"{c}{i}") for c in ("length", "copies", "page_id", "record_sha256")])
             for i, x in enumerate(suspect, 1)]
    both = named[0].join(named[1], ["shard", "offset"], "full")
    same = (F.col("record_sha2561").eqNullSafe(F.col("record_sha2562")) & F.col("length1").eqNullSafe(F.col("length2"))
            & F.col("copies1").eqNullSafe(F.col("copies2")))
    fault = F.when(F.col("record_sha2562").isNull(), "missing").when(F.col("record_sha2561").isNull(), "extra").otherwise("changed")
    return both.filter(~same).select(
        "shard", "offset", F.coalesce("length1", "length2").alias("length"), F.coalesce("page_id1", "page_id2").alias("page_id"),
        fault.alias("fault"), F.col("record_sha2561").alias("first_sha256"), F.col("record_sha2562").alias("second_sha256"))
