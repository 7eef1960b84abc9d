from __future__ import annotations

import re
from itertools import combinations

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from eventmart.llm import length_buckets as lb
from tests.llm.cases import awkward, documents


def padding(histogram, ends):
    return sum(n * (min(e for e in ends if e >= length) - length) for length, n in histogram)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(0, 300), st.integers(1, 50), min_size=1, max_size=9), st.integers(1, 5))
def test_boundaries_need_the_least_padding(counts, buckets):
    histogram = sorted(counts.items())
    lengths = [length for length, _ in histogram]
    ends = lb.best_boundaries(histogram, buckets)
    assert len(ends) <= buckets and ends == sorted(set(ends)) and ends[-1] == lengths[-1]
    least = min(padding(histogram, [*pick, lengths[-1]]) for k in range(buckets) for pick in combinations(lengths[:-1], k))
    assert padding(histogram, ends) == least


def test_long_documents_get_optimal_boundaries_too(spark):
    """Lengths far above the budget are not rounded."""
    lengths = [70_001] * 5 + [70_010] + [70_030] * 5 + [200_003, 1_000_007]
    docs = spark.createDataFrame([(i, "", n) for i, n in enumerate(lengths)], "doc_id long, text string, n long")
    for buckets in (2, 3, 4):
        got = lb.pack(docs, buckets=buckets, length_col="n").collect()
        histogram = sorted({n: lengths.count(n) for n in lengths}.items())
        least = min(padding(histogram, [*pick, 1_000_007]) for k in range(buckets)
                    for pick in combinations([n for n, _ in histogram[:-1]], k))
        assert sum(r["padding"] for r in got) == least and {r["bucket_len"] for r in got} <= set(lengths)
    short = docs.filter("n < 100000")
    assert sorted({r["bucket_len"] for r in lb.pack(short, buckets=2, length_col="n").collect()}) == [70_001, 70_030]


def test_rows_of_one_id_are_dealt_to_different_slices(spark):
    rows = [(7, f"text {i}") for i in range(200)] + [(None, f"other {i}") for i in range(200)]
    got = lb.pack(documents(spark, rows), buckets=1, budget=20).collect()
    assert len(got) == 400 and len({(r["batch"], r["slot"]) for r in got}) == 400


def test_batches_hold_the_budget(spark):
    rows = awkward()
    got = lb.pack(documents(spark, rows), buckets=4, budget=500).collect()
    assert len(got) == len(rows)
    lengths = sorted(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in rows)
    assert sorted(r["n_words"] for r in got) == lengths
    seen: dict = {}
    for r in got:
        holds = max(1, 500 // max(1, r["bucket_len"]))
        assert 0 <= r["slot"] < holds and r["padding"] == r["bucket_len"] - r["n_words"] >= 0
        seen.setdefault((r["bucket"], r["batch"]), []).append(r["slot"])
    for slots in seen.values():
        assert sorted(slots) == list(range(len(slots)))
    by_bucket: dict = {}
    for bucket, batch in seen:
        by_bucket.setdefault(bucket, []).append(batch)
    for bucket, batches in by_bucket.items():  # no gaps, and only the last batch is not full
        assert sorted(batches) == list(range(len(batches)))
        length = next(r["bucket_len"] for r in got if r["bucket"] == bucket)
        assert all(len(seen[bucket, b]) == max(1, 500 // max(1, length)) for b in range(len(batches) - 1))


def test_total_padding_is_optimal(spark):
    rows = awkward(4)
    got = lb.pack(documents(spark, rows), buckets=3).collect()
    histogram: dict = {}
    for r in got:
        histogram[r["n_words"]] = histogram.get(r["n_words"], 0) + 1
    lengths = sorted(histogram)
    least = min(padding(sorted(histogram.items()), [*pick, lengths[-1]]) for k in range(3) for pick in combinations(lengths[:-1], k))
    assert sum(r["padding"] for r in got) == least


def test_own_length_column_and_empty_table(spark):
    docs = documents(spark, [(1, "a b c"), (2, None), (3, "d")]).withColumn("tokens", F.lit(9))
    assert {r["n_words"] for r in lb.pack(docs, length_col="tokens").collect()} == {9}
    assert lb.pack(documents(spark, [])).count() == 0
