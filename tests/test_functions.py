import datetime as dt

from pyspark.sql import functions as F

from eventmart.functions.columns import (clean_text, count_where, guarded_ratio, ntz, pct, split_part,
                                         surrogate_key, thousands)


def test_scalar_semantics(spark):
    df = spark.createDataFrame([("a/b/c", 3, dt.date(2024, 1, 5)), (None, None, None), ("  ", 0, None)],
                               "s string, n int, d date")
    rows = df.select(
        split_part("s", "/", 2).alias("p2"), split_part("s", "/", 5).alias("p5"),
        clean_text("s").alias("clean"), surrogate_key("n", "d").alias("key"),
        guarded_ratio(F.lit(1), "n").alias("ratio"),
    ).collect()
    assert [r["p2"] for r in rows] == ["b", None, ""]          # null -> null, missing -> ''
    assert [r["p5"] for r in rows] == ["", None, ""]           # out of range -> ''
    assert [r["clean"] for r in rows] == ["a/b/c", None, None]  # blank -> null
    assert [r["key"] for r in rows] == ["3-2024-01-05", None, None]  # null-propagating concat
    assert [r["ratio"] for r in rows] == [1 / 3, 0.0, 0.0]      # guarded division
    agg = df.agg(count_where(F.col("n") > 100).alias("none")).collect()[0]
    assert agg["none"] == 0                                      # count_if: 0, not null


def test_report_formatting_and_wall_clock_literal(spark):
    r = spark.range(1).select(pct(F.lit(0.0625)).alias("p"), thousands(F.lit(5528301)).alias("t"),
                              ntz(dt.datetime(2024, 1, 2, 3, 4, 5)).alias("ts")).collect()[0]
    assert r["p"] == "6.2500%" and r["t"] == "5,528,301"
    assert r["ts"] == dt.datetime(2024, 1, 2, 3, 4, 5)
