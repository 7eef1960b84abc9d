"""The corpus pipeline: language ID, exact and near deduplication, source mix, packing.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns
what it keeps of docs, with the columns of documents, but for the last one, which
returns the packing. ``run`` applies them to the table documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventmart.llm import apportion, grace_dedup, lang_rank, length_buckets, simhash_pivots, token_histogram
from eventmart.llm.common import SPACE, WORD, attach, drop_stage, free_name, stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the profiles of this corpus know.

    Rejected are documents without a letter (and null texts), and all if no row has a
    language to learn from. Repeated rows and null ids are judged each; other columns,
    whatever their names, stay as they are.
    """
    profiles = lang_rank.learn(docs.filter(lang_rank.fold(F.col("doc_id"), 5) != 0))
    pred, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    found = lang_rank.identify(docs, profiles, pred_col=pred, score_col=score)
    return found.filter(F.col(pred) != "und").drop(pred, score)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the row that ``exact_duplicates`` keeps.

    Null counts as the empty text; of rows equal in id and text one stays; a null id
    is an id like others; other columns stay as they are.
    """
    kept = grace_dedup.exact_duplicates(docs).filter("kept").select("doc_id", "row_key")
    return attach(docs, kept)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id (null last), of each group of near-equal fingerprints.

    Texts without a word share fingerprint zero and are a group; of rows equal in id
    and text one stays; other columns stay as they are.
    """
    groups = simhash_pivots.near_duplicates(docs, shingle=3, bits=3)
    # ids can be null or repeated: a component is named by its root, and its one row is the first by (id, row)
    first = groups.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("first"))
    return attach(docs, first.select("first.doc_id", "first.row_key"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: whole copies, then one cut after the leading words that remain.

    A cut copy keeps the white space between its words. Texts without a word are never
    taken; rows equal in id and text count as one document as large as all of them;
    n_chars, where there is one, is that of the copy.
    """
    mixed = apportion.mix(docs).groupBy("doc_id", "row_key").agg(F.sum("taken").alias("taken"), F.max("size").alias("size"))
    rows = attach(docs, mixed.filter("taken > 0"), "taken", "size")
    taken, size = (F.col([c for c in rows.columns if c.endswith(f"decided_{x}")][-1]) for x in ("taken", "size"))
    whole, rest = F.floor(taken / size), taken % size
    copy = free_name(rows, "copy")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), whole + F.when(rest > 0, 1).otherwise(0)))
    rows = rows.withColumn(copy, copies)
    # each word with the white space before it, the first ones joined as they stand
    lead = F.concat_ws("", F.slice(F.regexp_extract_all("text", F.lit(f"({SPACE}*{WORD})"), 1), F.lit(1), rest.cast("int")))
    text = F.when(F.col(copy) <= whole, F.col("text")).otherwise(lead)
    rows = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, bucket, bucket_len, batch, slot, padding) of every row; null and empty texts have length 0."""
    lengths = token_histogram.token_lengths(docs.select("doc_id", "text"))
    return length_buckets.pack(lengths, length_col="n_tokens").withColumnRenamed("n_words", "n_tokens")


STAGES = [("language", language), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("source_mix", source_mix),
          ("packing", packing)]

#: no SQL: fingerprints, profiles and optimal boundaries are beyond it; tests hold each stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result staged as the next one's input and deleted after that one."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, function in STAGES[:-1]:
        docs, path = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            drop_stage(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
