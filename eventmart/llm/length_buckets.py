"""Packing by optimal length buckets.

The histogram of all document lengths is aggregated once; dynamic programming
over it chooses the bucket boundaries that need the least padding. Documents of
a bucket are dealt, in an order seeded by their digest, to batches that hold as
many padded documents as the token budget allows.

The histogram is the only thing that reaches the driver: a pair of numbers per
distinct length, so it is bounded by the longest document, not by their number.
Positions within a bucket come from
slices of the digest (counts per slice, then positions in the slice), so no
task holds a whole bucket.

Defined cases: null and empty texts have length 0 and are packed too; a
document longer than the budget forms a batch of its own; repeated rows and
null doc_ids are packed each, their order within equal ones is open; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from array import array

from pyspark.sql import DataFrame, Window, functions as F

from eventmart.llm.common import stage, word_count

BUCKETS = 16
BUDGET = 65_536
SLICE_DIGITS = 3


def best_boundaries(histogram: list[tuple[int, int]], buckets: int) -> list[int]:
    """Upper boundaries of at most ``buckets`` buckets with the least total padding.

    histogram: (length, documents) in order. With one bucket more, the best cost
    up to length j is length_j * N_j - S_j + min over i of (cost_i + S_i -
    length_j * N_i), where N and S sum documents and lengths before a position:
    a lower envelope of lines of falling slope asked at rising lengths, so each
    layer takes linear time.
    """
    d = len(histogram)
    if not d:
        return []
    n, s = [0], [0]
    for length, count in histogram:
        n.append(n[-1] + count)
        s.append(s[-1] + length * count)
    cost: list[float] = [0.0] + [float("inf")] * d
    cuts: list[array] = []
    for _ in range(min(buckets, d)):
        lines: list[tuple[int, float, int]] = []  # slope, intercept, position
        head = 0
        layer, cut = [float("inf")] * (d + 1), array("q", bytes(8 * (d + 1)))
        for j in range(1, d + 1):
            i = j - 1
            if cost[i] < float("inf"):
                slope, start = -n[i], cost[i] + s[i]
                while len(lines) - head >= 2:
                    (m1, b1, _), (m2, b2, _) = lines[-2], lines[-1]
                    if (start - b1) * (m1 - m2) <= (b2 - b1) * (m1 - slope):
                        lines.pop()
                    else:
                        break
                lines.append((slope, start, i))
            x = histogram[j - 1][0]
            while len(lines) - head >= 2 and lines[head + 1][0] * x + lines[head + 1][1] <= lines[head][0] * x + lines[head][1]:
                head += 1
            if len(lines) > head:
                slope, start, cut[j] = lines[head]
                layer[j] = x * n[j] - s[j] + slope * x + start
        cuts.append(cut)
        if layer[d] >= cost[d]:
            cuts.pop()
            break
        cost = layer
    ends, j = [], d
    for cut in reversed(cuts):
        ends.append(histogram[j - 1][0])
        j = cut[j]
    return ends[::-1]


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, seed: str = "pack", id_col: str = "doc_id",
         text_col: str = "text", length_col: str | None = None, slice_digits: int = SLICE_DIGITS) -> DataFrame:
    """(doc_id, n_words, bucket, bucket_len, batch, slot, padding), a row per input row.

    Lengths are word counts, or those of ``length_col`` (say, token counts; null
    is 0). A batch is (bucket, batch) and holds at most max(1, budget // bucket_len)
    documents, so at most budget words with padding.
    """
    length = word_count(F.col(text_col)) if length_col is None else F.coalesce(F.col(length_col).cast("long"), F.lit(0))
    # the text as well: copies of one id, or rows without one, must not share a place
    name = F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    rows = docs.select(F.col(id_col).alias("doc_id"), length.alias("n_words"), F.md5(name).alias("place"))
    rows, _ = stage(rows, "pack-rows")
    counted = rows.groupBy("n_words").count().toArrow()
    histogram = sorted(zip(counted["n_words"].to_pylist(), counted["count"].to_pylist(), strict=True))
    ends = best_boundaries(histogram, buckets)
    bucket, boundary = F.lit(0), F.lit(0).cast("long")
    for i, end in reversed(list(enumerate(ends))):
        fits = F.col("n_words") <= end
        bucket, boundary = F.when(fits, F.lit(i)).otherwise(bucket), F.when(fits, F.lit(end).cast("long")).otherwise(boundary)
    rows = rows.withColumns({"bucket": bucket, "bucket_len": boundary, "slice": F.substring("place", 1, slice_digits)})
    counts = rows.groupBy("bucket", "slice").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", "slice", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    offsets, _ = stage(offsets, "pack-offsets")  # at most buckets x 16 ** slice_digits rows
    inside = Window.partitionBy("bucket", "slice").orderBy("place", "doc_id", "n_words")
    placed = rows.withColumn("row", F.row_number().over(inside)).join(offsets, ["bucket", "slice"])
    holds = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest("bucket_len", F.lit(1))))
    position = F.col("offset") + F.col("row") - 1
    return placed.select("doc_id", "n_words", "bucket", "bucket_len", F.floor(position / holds).alias("batch"),
                         F.pmod(position, holds).alias("slot"), (F.col("bucket_len") - F.col("n_words")).alias("padding"))
