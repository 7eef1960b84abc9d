from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from eventmart.llm.common import attach, connected_components, row_key, word_count
from tests.llm.cases import awkward, documents, groups


def test_word_count_is_the_pattern_count(spark):
    rows = awkward()
    got = documents(spark, rows).select("text", word_count(F.col("text")).alias("n")).collect()
    for text, n in got:
        assert n == len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_components_match_union_find(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    links += [(1000, k) for k in range(1001, 1400)]                   # a hub
    links += [(2000 + k, 2001 + k) for k in range(60)] + [(5, 5)]     # a chain, a loop
    edges = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    want = groups({n for link in links for n in link if link[0] != link[1]}, [x for x in links if x[0] != x[1]])
    assert got == want


def test_components_of_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_attach_keeps_one_of_identical_rows_and_all_columns(spark):
    docs = documents(spark, [(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c"), (-1, "c"), (2, None)])
    decisions = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row_key")).distinct().withColumn("note", F.lit(7))
    got = attach(docs, decisions, "note")
    assert got.columns == [*docs.columns, "decided_note"]
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in got.collect()) == [(-1, "c"), (0, "c"), (1, "a"), (1, "b"), (2, "")]
