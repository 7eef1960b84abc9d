"""Language ID by rank-order n-gram profiles and the out-of-place distance.

A profile is the list of the ``size`` most frequent n-grams (1 to 3 letters,
words padded by a blank) in order of frequency. ``learn`` counts the n-grams of
every whole training text per language; a document's own profile is compared to
each of them: an n-gram at rank r here and rank s there is out of place by
|r - s|, a missing one by ``size``. The language of the least mean distance wins.

Defined cases: a null text or one without a letter is ``und`` with score 0, as
is every text when nothing was learned; ties go to the smaller language name;
null languages are not learned from; repeated rows count each; an empty table
gives an empty result; input columns other than text and lang are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf

from eventmart.llm.common import free_name

SIZE = 300
CHUNK_CHARS = 1 << 19
#: stands for whatever separates words
GAP = 1
#: slices that the n-grams of one language are ranked in before the last ranking
SLICES = 64


@lru_cache(1)
def _letters() -> np.ndarray:
    """Code point -> code point of its lower-case letter, GAP for anything that is no letter."""
    table = np.full(0x110000, GAP, np.int64)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            table[i] = ord(low) if len(low := c.lower()) == 1 else i
    return table


def _grams(text: str) -> np.ndarray:
    """All 1- to 3-grams, repeats included, as one integer each: 21 bits a character, none
    of which is 0, so grams of different lengths never share a number."""
    codes = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    codes = np.concatenate([[GAP], codes, [GAP]])
    codes = codes[np.r_[True, (codes[1:] != GAP) | (codes[:-1] != GAP)]]
    one = codes[codes != GAP]
    two = codes[:-1] << 21 | codes[1:]
    middle = codes[1:-1] != GAP
    three = (two[:-1] << 21 | codes[2:])[middle]
    return np.concatenate([one, two, three]) if len(one) else one


def _counts(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    grams = np.sort(grams)
    at = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
    return grams[at], np.diff(np.r_[at, len(grams)])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) for each batch; texts are counted in chunks of bounded length."""
    for batch in batches:
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            parts, chunk, size = [], [], 0
            for i, text in enumerate(texts):
                chunk.append(text)
                size += len(text)
                if size >= CHUNK_CHARS or i == len(texts) - 1:
                    if len(grams := _grams(" ".join(chunk))):
                        parts.append(_counts(grams))
                    chunk, size = [], 0
            if parts:
                grams, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(which, np.concatenate([p[1] for p in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams), pa.array(n)],
                                                 ["lang", "gram", "n"])


def learn(docs: DataFrame, size: int = SIZE, text_col: str = "text", lang_col: str = "lang") -> dict[str, list[int]]:
    """Language -> its n-grams in order of frequency (ties: smaller code first).

    Counts cover all rows of docs. What reaches the driver is bounded by
    languages x SLICES x size rows, whatever the number of documents.
    """
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = rows.mapInArrow(_count_batches, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang", F.pmod("gram", F.lit(SLICES))).orderBy(F.desc("n"), "gram")
    top = counts.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= size)
    found: dict[str, list[tuple[int, int]]] = {}
    for row in top.select("lang", "gram", "n").toLocalIterator():
        found.setdefault(row["lang"], []).append((-row["n"], row["gram"]))
    return {lang: [gram for _, gram in sorted(grams)[:size]] for lang, grams in sorted(found.items())}


class Profiles:
    """The learned profiles as one rank table: a row per language, a column per n-gram."""

    def __init__(self, profiles: dict[str, list[int]], size: int = SIZE):
        self.langs, self.size = sorted(profiles), size
        self.grams = np.array(sorted({g for p in profiles.values() for g in p}), np.int64)
        self.ranks = np.full((len(self.langs), len(self.grams) + 1), -1, np.int64)
        for k, lang in enumerate(self.langs):
            self.ranks[k, np.searchsorted(self.grams, np.array(profiles[lang], np.int64))] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        grams = _grams(text) if text else ()
        if not len(grams) or not self.langs:
            return "und", 0.0
        grams, n = _counts(grams)
        if len(grams) > self.size:  # all that are as frequent as the last one, before the exact order
            least = np.partition(n, len(n) - self.size)[len(n) - self.size]
            grams, n = grams[n >= least], n[n >= least]
        grams = grams[np.lexsort((grams, -n))][:self.size]
        at = np.searchsorted(self.grams, grams)
        at[at == len(self.grams)] = -1
        at = np.where(self.grams[at] == grams, at, len(self.grams))
        ranks = self.ranks[:, at]
        apart = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(grams)))).sum(1)
        best = int(apart.argmin())
        return self.langs[best], float(1 - apart[best] / (self.size * len(grams)))


def identify(docs: DataFrame, profiles: dict[str, list[int]], size: int = SIZE, text_col: str = "text",
             pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """docs with two columns more: the predicted language and 1 - mean out-of-place distance / size.

    Columns of docs that already have these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profiles)  # languages x size integers
    made: list[Profiles] = []

    @pandas_udf("lang string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        if not made:
            made.append(Profiles(shared.value, size))
        return pd.DataFrame([made[0].predict(t) for t in texts], columns=["lang", "score"])

    both = free_name(docs, "found")
    return docs.withColumn(both, predicted(F.col(text_col))).withColumns(
        {pred_col: F.col(both)["lang"], score_col: F.col(both)["score"]}).drop(both)


def fold(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo k; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(k))
