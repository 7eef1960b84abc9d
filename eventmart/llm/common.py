"""Shared pieces of the corpus operators: word rule, staged tables, link components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from eventmart.session import scratch_path

#: a word is a maximal run of anything but these (space and U+0009..U+000D)
WORD = "[^\\x20\\x09-\\x0D]+"
SPACE = "[\\x20\\x09-\\x0D]"


def word_count(text: Column) -> Column:
    """Words of a text as long; 0 for a null text.

    A word starts where a non-space follows the text's start or a space, so it is
    enough to shrink every word to one character and every gap to nothing.
    """
    return F.coalesce(F.length(F.regexp_replace(F.regexp_replace(text, WORD, "x"), SPACE, "")), F.lit(0)).cast("long")


def row_key(doc_id: Column, text: Column) -> Column:
    """64-bit digest that tells rows of one doc_id apart by their text."""
    return F.xxhash64(doc_id.isNull(), doc_id, text.isNull(), text)


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores put before it until df has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def stage(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write df as Parquet under spark.checkpoint.dir and read it back.

    Cuts lineage: every later read sees the committed files, whatever executor
    wrote them. Returns the table and its path, for ``drop_stage``.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_stage(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def attach(docs: DataFrame, decisions: DataFrame, *columns: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each (doc_id, row_key) of decisions, with some of their columns more.

    decisions must hold a (doc_id, row_key) once. Identical rows of docs count as one.
    The join and the choice among identical rows share one exchange of docs.
    """
    own = {c: free_name(docs, f"decided_{c}") for c in columns}
    kid, key = free_name(docs, "kid"), free_name(docs, "row_key")
    known = decisions.select(F.coalesce("doc_id", F.lit(-1)).alias(kid), F.col("row_key").alias(key),
                             *[F.col(c).alias(name) for c, name in own.items()])
    rows = docs.withColumn(kid, F.coalesce(F.col(id_col).cast("long"), F.lit(-1))).withColumn(key, row_key(F.col(id_col), F.col(text_col)))
    first = free_name(docs, "first")
    same = Window.partitionBy(kid, key).orderBy(F.lit(1))
    joined = rows.join(known, [kid, key]).withColumn(first, F.row_number().over(same)).filter(F.col(first) == 1)
    return joined.drop(kid, key, first)


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Smallest node reachable from every node of an undirected edge list.

    edges: columns a, b (long). Returns (node, root) for every node that has an
    edge. Alternates the large-star and small-star steps: a node hands its
    larger (then its smaller) neighbours to its smallest one, until the edges
    are stars around the roots. Each step is a partial aggregation and a join
    on the edge list, staged in the shared folder; a hub's minimum is
    pre-aggregated per task and its edges are split by the skew join. Only a
    row count and a checksum reach the driver.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    current, path = stage(pairs, name)
    seen = _signature(current)
    while seen[0]:
        both = current.select("u", "v").unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(lowest, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        large, large_path = stage(large, name)
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
        small, small_path = stage(small, name)
        now = _signature(small)
        drop_stage(spark, path)
        drop_stage(spark, large_path)
        current, path = small, small_path
        if now == seen:
            break
        seen = now
    return (current.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                           F.sum(F.xxhash64("v", "u", F.lit(1)).cast("decimal(38,0)"))).first())
