"""Source divergence audit: how far each source of a language is from its siblings and its language.

Terms are counted by an Arrow compute pipeline inside mapInArrow: ``ascii_lower``,
``split_pattern_regex``, ``dictionary_encode`` and two hash ``group_by`` steps (per
document, then per group), merged over the batches of a task. Spark adds the
partial counts up; a language keeps the terms of at least ``min_docs`` of its
documents. The kept counts are then dealt to columnar shards (language, slice of
terms, pair of source tiles), where dense blocks of integer probabilities give the
divergences: the absolute difference of each two sources summed over all kept
terms, and the terms that a source overuses most against its language.

All arithmetic is exact: p = 1 + floor(10^9 (count + 5) / (N + 5 V)) is divided in
two integer steps that fit 64 bits for up to 2.8 * 10^14 counted words.

Defined cases: null text, lang and source count as ''; a document without terms
still makes its (lang, source) group occur; a group without kept terms has count 0
everywhere; a language without kept terms gives pairs of value 0 and no terms;
repeated rows count each; ties rank by the item's UTF-8 bytes; an empty table gives
an empty result; other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from eventmart.llm.common import drop_stage, stage

#: what separates terms: ASCII but its letters (texts are lower-cased first)
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 30
TOP = 50
SMOOTH = 5
#: rows of partial counts a task holds before it hands them on
HELD_ROWS = 1 << 19
#: bytes of text split at once (a longer text is split alone)
CHUNK_BYTES = 16 << 20
#: kept counts a shard should hold, and sources a tile
SHARD_ROWS = 200_000
TILE = 256
#: cells of a dense block
BLOCK_CELLS = 1 << 21

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.Table]:
    table = pa.Table.from_batches([batch])
    sizes = np.cumsum(pc.fill_null(pc.binary_length(table["text"]), 0).to_numpy())
    start = 0
    while start < len(sizes):
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + CHUNK_BYTES, "right")))
        yield table.slice(start, end - start)
        start = end


def _count(rows: pa.Table) -> pa.Table:
    """(lang, source, term, n, docs) of some documents; term '' stands for the group itself."""
    text, lang, source = (pc.fill_null(rows[c], "").combine_chunks().cast(pa.string()) for c in ("text", "lang", "source"))
    words = pc.split_pattern_regex(pc.ascii_lower(text), pattern=BETWEEN)
    terms = pc.list_flatten(words).dictionary_encode()
    table = pa.table({"doc": pc.list_parent_indices(words), "term": terms.indices})
    in_doc = table.group_by(["doc", "term"], use_threads=False).aggregate([([], "count_all")])
    groups = pa.table({"lang": lang, "source": source, "doc": pa.array(np.arange(len(rows), dtype=np.int64))})
    named = groups.group_by(["lang", "source"], use_threads=False).aggregate([("doc", "list"), ("doc", "count")])
    group_of = np.empty(len(rows), np.int64)
    group_of[pc.list_flatten(named["doc_list"]).to_numpy()] = pc.list_parent_indices(named["doc_list"]).to_numpy()
    counted = pa.table({"group": group_of[in_doc["doc"].to_numpy()], "term": in_doc["term"], "n": in_doc["count_all"]})
    counted = counted.group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    out = pa.table([named["lang"].take(counted["group"]), named["source"].take(counted["group"]),
                    terms.dictionary.take(counted["term"].combine_chunks()), counted["n_sum"], counted["n_count"]], schema=_COUNTS)
    marks = pa.table([named["lang"], named["source"], pa.array([""] * len(named), pa.string()),
                      pa.array([0] * len(named), pa.int64()), named["doc_count"]], schema=_COUNTS)
    return pa.concat_tables([out.filter(pc.not_equal(out["term"], "")), marks])


def _merge(parts: list[pa.Table]) -> pa.Table:
    merged = pa.concat_tables(parts).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return merged.rename_columns(["lang", "source", "term", "n", "docs"]).cast(_COUNTS)


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    for batch in batches:
        for rows in _chunks(batch):
            held.append(_count(rows))
            if sum(map(len, held)) > HELD_ROWS:
                held = [_merge(held)]
                if len(held[0]) > HELD_ROWS // 2:
                    yield from held.pop().to_batches(max_chunksize=1 << 16)
    if held:
        yield from _merge(held).to_batches(max_chunksize=1 << 16)


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term; term '' counts all documents of the group."""
    rows = docs.select(*[F.col(c).cast("string").alias(name) for c, name in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    partial = rows.mapInArrow(_partial_counts, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(10^9 (count + SMOOTH) / total), exact: 10^9 = 31250 * 32000."""
    first = (count + SMOOTH) * 31250
    return 1 + first // total * 32000 + first % total * 32000 // total


def _divergences(top: int, tile: int):
    """The function of one shard: (key, kept counts, sources of the tiles) -> partial pair sums and each source's first terms."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])

    def shard(key: tuple, kept: pa.Table, sources: pa.Table) -> pa.Table:
        lang, _, tile_a, tile_b = (k.as_py() for k in key)
        sources = sources.sort_by("place")
        places, names = sources["place"].to_numpy(), sources["source"]
        totals = sources["n_group"].to_numpy() + SMOOTH * sources["n_terms"].to_numpy()
        in_a, in_b = np.flatnonzero(places // tile == tile_a), np.flatnonzero(places // tile == tile_b)
        sums = np.zeros((len(in_a), len(in_b)), np.int64)
        out = []
        if len(kept):
            words = kept["term"].combine_chunks().dictionary_encode()
            term, row = words.indices.to_numpy(), np.searchsorted(places, kept["place"].to_numpy())
            n, n_words = kept["n"].to_numpy(), len(words.dictionary)
            order = np.argsort(term, kind="stable")
            term, row, n = term[order], row[order], n[order]
            step = max(1, BLOCK_CELLS // len(places))
            for start in range(0, n_words, step):
                at = slice(*np.searchsorted(term, [start, start + step]))
                count = np.zeros((len(places), min(step, n_words - start)), np.int64)
                count[row[at], term[at] - start] = n[at]
                p = _share(count, totals[:, None])
                for i, a in enumerate(in_a):
                    sums[i] += np.abs(p[in_b] - p[a]).sum(1)
            if tile_a == tile_b:
                lang_total = int(sources["n_lang"][0].as_py()) + SMOOTH * int(sources["n_terms"][0].as_py())
                over = _share(n, totals[row]) - _share(kept["n_term"].to_numpy()[order], lang_total)
                found = pa.table({"row": row[over > 0], "value": over[over > 0], "item": words.dictionary.take(pa.array(term[over > 0]))})
                found = found.sort_by([("row", "ascending"), ("value", "descending"), ("item", "ascending")])
                rows = found["row"].to_numpy()
                nth = np.arange(len(rows)) - np.searchsorted(rows, rows)
                found = found.filter(pa.array(nth < top))
                out.append(pa.table([pa.array([lang] * len(found), pa.string()), names.take(found["row"]), pa.array(["term"] * len(found), pa.string()),
                                     found["item"], found["value"]], schema=schema))
        i, j = np.nonzero(places[in_a][:, None] < places[in_b][None, :])
        out.append(pa.table([pa.array([lang] * len(i), pa.string()), names.take(pa.array(in_a[i])), pa.array(["pair"] * len(i), pa.string()),
                             names.take(pa.array(in_b[j])), pa.array(sums[i, j])], schema=schema))
        return pa.concat_tables(out)

    return shard


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", shard_rows: int = SHARD_ROWS, tile: int = TILE) -> DataFrame:
    """(lang, source, part, item, value, rank) of every occurring (lang, source).

    Part ``pair``: item is another source of the language, value the sum over all
    kept terms of the absolute difference of both p. Part ``term``: item is a kept
    term that occurs in the group and whose p is above the language's, value the
    excess, ranks up to ``top``.

    A shard holds about shard_rows kept counts of at most two tiles of sources,
    whatever the size of a language: a term's hash deals it to its slice, and
    beyond ``tile`` sources counts are copied once per tile.
    """
    spark = docs.sparkSession
    counts, counts_path = stage(term_counts(docs, text_col, lang_col, source_col), "audit-counts")
    of_term = Window.partitionBy("lang", "term")
    kept = counts.filter("term <> ''").select(
        "lang", "source", "term", "n", F.sum("docs").over(of_term).alias("docs"), F.sum("n").over(of_term).alias("n_term"),
        (F.min("source").over(of_term) == F.col("source")).alias("first")).filter(F.col("docs") >= min_docs)
    kept, kept_path = stage(kept.drop("docs"), "audit-kept")

    in_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    in_lang = kept.groupBy("lang").agg(F.sum("n").alias("n_lang"), F.sum(F.col("first").cast("long")).alias("n_terms"))
    sources = counts.filter("term = ''").select(
        "lang", "source", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("place"),
        F.count("*").over(Window.partitionBy("lang")).alias("n_sources"))
    sources = sources.join(in_group, ["lang", "source"], "left").join(in_lang, "lang", "left").fillna(0, ["n_group", "n_lang", "n_terms"])
    sources, sources_path = stage(sources, "audit-sources")
    drop_stage(spark, counts_path)
    places = spark.read.schema(sources.schema).parquet(sources_path).select("lang", "source", "place", "n_sources")

    slices = max(1, -(-kept.count() // shard_rows))
    own = F.floor(F.col("place") / tile).alias("tile")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n_sources") / tile) - 1)).alias("other")
    dealt = ["lang", "slice", F.least("tile", "other").alias("tile_a"), F.greatest("tile", "other").alias("tile_b")]
    left = kept.join(places, ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("term"), F.lit(slices)).alias("slice"), "place", "term", "n", "n_term", own, other)
    right = sources.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice")).select(
        "*", own, other)
    left = left.select(*dealt, "place", "term", "n", "n_term")
    right = right.select(*dealt, "place", "source", "n_group", "n_lang", "n_terms")
    shard = ["lang", "slice", "tile_a", "tile_b"]
    found = left.groupBy(*shard).cogroup(right.groupBy(*shard)).applyInArrow(
        _divergences(top, tile), "lang string, source string, part string, item string, value long")
    found, _ = stage(found, "audit-shards")
    drop_stage(spark, kept_path)
    drop_stage(spark, sources_path)

    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("p")
    pairs = pairs.select("lang", "value", both).select("lang", "p.source", F.lit("pair").alias("part"), "p.item", "value")
    terms = found.filter("part = 'term'").select("lang", "source", "part", "item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    return pairs.select("*", rank).unionByName(terms.select("*", rank).filter(F.col("rank") <= top))
