"""Token counts as one exact histogram of encoded document lengths.

Every text is encoded whole; documents are then aggregated by length. Suffix
sums over the lengths answer, for any context limit: how many documents reach
it, how many tokens they hold, and how many remain when each document is cut there.

Defined cases: null and empty texts have length 0; repeated rows count each;
an empty table gives an empty histogram; other columns are ignored.
"""

from __future__ import annotations

import base64

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf

from eventmart.llm.common import stage

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published split pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: lengths per block of the two-step suffix sums
BLOCK = 1024


def encoder(vocabulary: bytes):
    """Byte-pair encoder from the lines (base64 token, rank) of a vocabulary file."""
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines()) if token}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_lengths(docs: DataFrame, vocabulary: str = VOCABULARY, text_col: str = "text", out_col: str = "n_tokens") -> DataFrame:
    """docs with the encoded length of each text (replacing a column of that name)."""
    with open(vocabulary, "rb") as file:  # a vocabulary is a small file beside the driver
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    made: list = []

    @pandas_udf("long")
    def length(texts: pd.Series) -> pd.Series:
        if not made:
            made.append(encoder(shared.value))
        return pd.Series([len(made[0].encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return docs.withColumn(out_col, length(F.col(text_col)))


def length_histogram(lengths: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """A row per distinct length: n_tokens, n_docs, docs_at_least, tokens_at_least, truncated_total, share_up_to.

    docs_at_least and tokens_at_least are sums over this length and all above;
    truncated_total is what remains of all tokens if documents are cut at this
    length; share_up_to is the share of documents of at most this length. The
    sums run in blocks of lengths first, so that no task holds all lengths.
    """
    counts = (lengths.groupBy(F.col(length_col).cast("long").alias("n_tokens")).agg(F.count("*").alias("n_docs"))
              .withColumn("block", F.floor(F.col("n_tokens") / BLOCK)))
    counts, _ = stage(counts, "token-histogram")  # read twice below; texts are encoded once
    sums = counts.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("t"))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = sums.select("block", F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"),
                         F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"),
                         F.sum("d").over(whole).alias("d_all"), F.sum("t").over(whole).alias("t_all"))
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    rows = counts.join(blocks, "block").select(
        "n_tokens", "n_docs", "d_all", "t_all",
        (F.sum("n_docs").over(inside) + F.col("d_above")).alias("docs_at_least"),
        (F.sum(F.col("n_docs") * F.col("n_tokens")).over(inside) + F.col("t_above")).alias("tokens_at_least"))
    return rows.select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least",
        (F.col("t_all") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_total"),
        ((F.col("d_all") - F.col("docs_at_least") + F.col("n_docs")) / F.col("d_all")).alias("share_up_to"))


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the least length that at least this share of the documents does not exceed."""
    asked = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    met = F.min(F.when(F.col("share_up_to") >= F.col("share"), F.col("n_tokens")))
    return histogram.select("n_tokens", "share_up_to", asked).groupBy("share").agg(met.alias("n_tokens"))


def truncated_totals(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(context, total): tokens left when every document is cut at context tokens, exact for any limit."""
    asked = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("context")
    kept = F.sum(F.col("n_docs") * F.least("n_tokens", "context"))
    return histogram.select("n_tokens", "n_docs", asked).groupBy("context").agg(kept.alias("total"))
