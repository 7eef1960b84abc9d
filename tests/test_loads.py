"""Loads that fail, replays that are cut, streams that are capped."""

import os

import pytest
from pyspark.sql import functions as F

from eventmart.sinks.replay import capped_stream, replay
from eventmart.sources.load import full_refresh, refresh_partitions


def ids(spark, path):
    return sorted(r["id"] for r in spark.read.parquet(path).collect())


def test_a_killed_load_leaves_the_old_rows(spark, scratch):
    dest = scratch("dest")
    assert full_refresh(spark.range(5), dest) == 5
    broken = spark.range(3).withColumn("id", F.when(F.col("id") == 2, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="killed"):
        full_refresh(broken, dest)
    assert ids(spark, dest) == [0, 1, 2, 3, 4]
    os.rename(dest, f"{dest}__before")                       # what a crash between the renames leaves
    with pytest.raises(Exception, match="killed"):
        full_refresh(broken, dest)
    assert ids(spark, dest) == [0, 1, 2, 3, 4]
    assert full_refresh(spark.read.parquet(dest).filter("id > 1"), dest) == 3     # reads what it replaces
    assert ids(spark, dest) == [2, 3, 4] and not os.path.exists(f"{dest}__before") and not os.path.exists(f"{dest}__loading")


def test_refresh_of_some_partitions(spark, scratch):
    dest = scratch("dest")
    rows = spark.range(10).withColumn("p", F.col("id") % 3)
    assert refresh_partitions(rows, dest, "p") == 10
    assert refresh_partitions(spark.createDataFrame([(50, 1), (51, 7)], "id long, p long"), dest, "p") == 2
    assert ids(spark, dest) == [0, 2, 3, 5, 6, 8, 9, 50, 51]


@pytest.mark.parametrize("limit", [1, 7, 999, 1000, 1001, 3700, 4000, 9999])
def test_the_first_lines_are_the_first_lines(spark, scratch, limit):
    src = scratch("src")
    os.makedirs(f"{src}/b")
    files = [f"{src}/z.txt", f"{src}/b/1.txt", f"{src}/b/2.txt", f"{src}/a.txt"]
    for k, f in enumerate(files):
        with open(f, "w") as fh:
            fh.write("".join(f"  {k}-{i}\t\n{' ' * (i % 3)}\n" for i in range(1000)))
    every = [f"{k}-{i}" for k in range(4) for i in range(1000)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")        # many splits a file
    try:
        dest = scratch("dest")
        assert replay(spark, [files[0], f"{src}/b", files[3]], dest, limit=limit) == min(limit, 4000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r.value for r in spark.read.text(dest).collect()) == sorted(every[:limit])


def test_no_micro_batch_of_one_large_file_exceeds_the_cap(spark, scratch):
    for lines, cap in (([5000], 300), ([40, 50, 10, 45], 100), ([3], 100)):
        src, sizes = scratch("src"), []
        os.makedirs(src)
        for k, n in enumerate(lines):
            with open(f"{src}/{k}.txt", "w") as fh:
                fh.write("".join(f"{k}-{i}\n" for i in range(n)))
            os.utime(f"{src}/{k}.txt", (1_700_000_000 + k, 1_700_000_000 + k))
        stream = capped_stream(spark, src, scratch("landed"), cap)
        q = (stream.writeStream.foreachBatch(lambda df, _, sizes=sizes: sizes.append(df.count()))
             .option("checkpointLocation", scratch("c")).trigger(availableNow=True).start())
        q.awaitTermination()
        assert max(sizes) <= cap and sum(sizes) == sum(lines)
