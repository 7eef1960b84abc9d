"""Mixing sources to target weights by Sainte-Lague apportionment, DataFrame functions only.

1. Sources in code-point order (null last) get the weights in turn; all of them
   share ``share`` times the corpus. A target stops at ``most`` times its
   source's size; the excess goes to the others by weight until none is above,
   that is, target = min(most x size, level x weight) for one level, found from
   running sums over the sources in order of size / weight.
2. ``sainte_lague`` allocates blocks of ``block`` words: first to the sources in
   proportion to their targets, then a source's blocks to its shards in
   proportion to their sizes. A seat goes to the highest quotient weight / (2k - 1).
   Nearly all seats are certain from bounds on the divisor; only two or
   three candidates per row are ranked, however many seats there are.
3. Within a shard, documents stand in an order seeded by the digest of their
   id. The shard's blocks are taken in this order, round after round.

A source has a shard per ``shard_words`` words (``MAX_SHARDS`` at most), dealt by
the digest: a hot source is many shards, and no step holds a whole source. The
ranking of sources holds a row per source, that of shards MAX_SHARDS rows per source.

Defined cases: null texts have size 0; a null source is a source of its own; a
corpus without words has targets 0; null doc_ids share a place in the order,
where their size decides; repeated rows count each; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from eventmart.llm.common import row_key, stage, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 64
SHARD_WORDS = 1 << 18
MAX_SHARDS = 4096


def sainte_lague(rows: DataFrame, group: list[str], key: str, weight: str, seats: str, quota: str) -> DataFrame:
    """rows (group, key, weight, seats) with the column quota: its part of the group's seats.

    The seats of a group go to the highest quotients weight / (2k - 1), k = 1, 2, ...;
    ties go to the smaller key. A row without weight gets none. With S rows, the
    divisor of the final allocation lies between total / (seats + S/2) and
    total / (seats - S/2), which fixes all but about three seats per row.
    """
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    w, n = F.col(weight).cast("double"), F.col(seats).cast("double")
    counted = rows.withColumns({"_total": F.sum(w).over(whole), "_rows": F.sum(F.when(w > 0, 1).otherwise(0)).over(whole).cast("double")})
    part = F.when(F.col("_total") > 0, w / F.col("_total")).otherwise(0.0)
    # one less than the bound, against rounding
    certain = F.greatest(F.ceil(part * (n - F.col("_rows") / 2) - 0.5) - 1, F.lit(0)).cast("long")
    possible = F.when(w > 0, F.greatest(F.floor(part * (n + F.col("_rows") / 2) + 0.5), certain) + 1).otherwise(0).cast("long")
    bounded = counted.withColumns({"_certain": certain, "_possible": possible}).withColumn(
        "_open", F.col(seats) - F.sum("_certain").over(whole))
    asked = bounded.filter(F.col("_possible") > F.col("_certain")).select(
        *group, key, weight, "_open", F.explode(F.sequence(F.col("_certain") + 1, F.col("_possible"))).alias("_k"))
    best = (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))).orderBy(
        F.desc(F.col(weight).cast("double") / (2 * F.col("_k") - 1)), F.col(key), "_k")
    won = (asked.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= F.col("_open"))
           .groupBy(*group, key).agg(F.count("*").alias("_won")))
    return (bounded.join(won, [*group, key], "left").withColumn(quota, F.col("_certain") + F.coalesce("_won", F.lit(0)))
            .drop("_total", "_rows", "_certain", "_possible", "_open", "_won"))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(skey, source, source_size) with rank and target; share is a multiple of one half."""
    halves = round(2 * share)
    everything = Window.partitionBy(F.lit(0))
    ranked = sources.withColumn("rank", F.row_number().over(everything.orderBy(F.asc_nulls_last("source"))))
    weight = F.element_at(F.array(*[F.lit(x) for x in weights]), F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int") + 1)
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * most)
    by_room = everything.orderBy(F.col("most") / F.col("weight"), "rank")
    ranked = ranked.withColumns({
        "full": F.sum("most").over(by_room) - F.col("most"),                 # what sources with less room take if full
        "rest": F.sum("weight").over(everything) - F.sum("weight").over(by_room) + F.col("weight"),
        "total": F.sum("source_size").over(everything)})
    level = (halves * F.col("total") - 2 * F.col("full")) / (2 * F.col("rest"))
    ranked = ranked.withColumn("level", F.max(F.when(level * F.col("weight") <= F.col("most"), level)).over(everything))
    target = F.least(F.col("most").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("most").cast("double")))
    return ranked.select("skey", "source", "source_size", "rank", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, block: int = BLOCK_WORDS,
        shard_words: int = SHARD_WORDS, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """(doc_id, row_key, source, size, source_size, target, taken), a row per input row.

    taken: the words that the mix takes of this document, whole rounds and then
    a leading part; at most ``most`` times its size.
    """
    source = F.col(source_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), row_key(F.col(id_col), F.col(text_col)).alias("row_key"), source.alias("source"),
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("skey"), word_count(F.col(text_col)).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("place"))
    rows, _ = stage(rows, "mix-rows")
    sources = rows.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    targets = source_targets(sources, weights, share, most)
    total = F.sum("source_size").over(Window.partitionBy(F.lit(0)))
    targets = targets.withColumn("seats", F.floor(total * share / block + 0.5).cast("long"))
    quotas = sainte_lague(targets, [], "rank", "target", "seats", "quota").select(
        "skey", "source_size", "target", "quota",
        F.greatest(F.lit(1), F.least(F.lit(MAX_SHARDS), F.ceil(F.col("source_size") / shard_words))).cast("int").alias("shards"))
    quotas, _ = stage(quotas, "mix-sources")  # a row per source; the joins are free to broadcast it by size
    number = F.conv(F.substring("place", 1, 8), 16, 10).cast("long")
    dealt = rows.join(quotas.select("skey", "source_size", "target", "shards"), "skey").withColumn(
        "shard", F.pmod(number, F.col("shards")).cast("int"))
    sizes = rows.join(quotas.select("skey", "shards", "quota"), "skey").groupBy(
        "skey", "quota", F.pmod(number, F.col("shards")).cast("int").alias("shard")).agg(F.sum("size").alias("shard_size"))
    shard_quotas = sainte_lague(sizes, ["skey"], "shard", "shard_size", "quota", "blocks").select("skey", "shard", "shard_size", "blocks")
    shard_quotas, _ = stage(shard_quotas, "mix-shards")
    ahead = Window.partitionBy("skey", "shard").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("ahead", F.coalesce(F.sum("size").over(ahead), F.lit(0))).join(shard_quotas, ["skey", "shard"])
    words = F.least(F.col("blocks") * block, F.col("shard_size") * most)
    rounds = F.when(F.col("shard_size") > 0, F.floor(words / F.col("shard_size"))).otherwise(0).cast("long")
    part = F.least(F.greatest(words - rounds * F.col("shard_size") - F.col("ahead"), F.lit(0)), F.col("size"))
    return placed.select("doc_id", "row_key", "source", "size", "source_size", "target",
                         (rounds * F.col("size") + part).cast("long").alias("taken"))
