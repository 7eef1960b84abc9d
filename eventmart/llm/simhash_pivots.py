"""SimHash near-duplicate groups by pivot distance tables.

1. ``fingerprints``: a 64-bit SimHash per document over word shingles.
2. Equal fingerprints collapse to one row (partial aggregation), so a group of
   exact copies, however large, is one row from here on.
3. ``pivot_table``: each distinct fingerprint gets its Hamming distances to
   ``PIVOTS`` reference fingerprints, computed once and carried along.
4. Candidates: a distance to one random reference tells little on its own
   (it lies near 32 for nearly all fingerprints), so a pivot table alone would
   have to look at all pairs. Fingerprints are therefore dealt to cells first:
   the 64 bits are cut into ``bits + 2`` blocks, and two fingerprints within
   ``bits`` differing bits agree on at least two whole blocks, hence meet in a cell
   of that pair of blocks. Cells above ``tile_rows`` are cut into tiles, one
   task row range per pair of tiles.
5. Inside a cell, pairs whose pivot coordinates differ by more than ``bits``
   anywhere are discarded (triangle inequality: the difference of two distances
   to a reference is at most the distance of the pair); survivors are verified
   on the fingerprints.
6. A cell hands on a star per connected group of its links, never all pairs;
   ``connected_components`` joins the stars.

Defined cases: null and blank texts have fingerprint 0, linked like any other;
fewer words than a shingle make one shingle of all words; null doc_ids keep a
row and their group's smallest non-null doc_id (null if there is none);
repeated rows stay; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from eventmart.llm.common import connected_components, drop_stage, row_key, stage

PIVOTS = 32
#: one tile of a cell; a pair of tiles is compared in one go
TILE_ROWS = 1024


def reference_fingerprints(n: int = PIVOTS) -> list[int]:
    """The reference fingerprints: XXH64 digests of 0, 1, 2, ..."""
    return [xxhash.xxh64_intdigest(str(i).encode(), seed=0) for i in range(n)]


def simhash(text: str | None, shingle: int) -> int:
    """64-bit fingerprint: bit set where over half of the shingle hashes set it."""
    # bytes.lower and bytes.split know exactly A-Z and the six ASCII spaces
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), 42)
    columns = [words[i:] for i in range(shingle)]
    hashes = np.array([digest(b" ".join(s), 42) for s in zip(*columns, strict=False)], np.uint64)
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at:at + 65536]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row_key, fp): the fingerprint as signed long, a row per input row."""

    @pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        found = np.fromiter((simhash(t, shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    doc_id, text = F.col(id_col).alias("doc_id"), F.col(text_col)
    return docs.select(doc_id, row_key(F.col(id_col), text).alias("row_key"), fp(text).alias("fp"))


def pivot_table(fps: DataFrame, pivots: int = PIVOTS) -> DataFrame:
    """Adds d0, d1, ...: the distances to the references, eight to a long, a byte each."""
    signed = np.array(reference_fingerprints(pivots), np.uint64).view(np.int64).tolist()
    out = {}
    for at in range(0, pivots, 8):
        word = F.lit(0).cast("long")
        for k, ref in enumerate(signed[at:at + 8]):
            word = word.bitwiseOR(F.shiftleft(F.bit_count(F.col("fp").bitwiseXOR(F.lit(ref))).cast("long"), 8 * k))
        out[f"d{at // 8}"] = word
    return fps.withColumns(out)


def _cells(table: DataFrame, bits: int) -> DataFrame:
    """A row per fingerprint and pair of blocks: cell says which blocks and their bits."""
    n = bits + 2
    edges = [64 * i // n for i in range(n + 1)]

    def block(i: int):
        width = edges[i + 1] - edges[i]
        return F.shiftrightunsigned("fp", edges[i]).bitwiseAND(F.lit((1 << width) - 1).cast("long"))

    kept = [F.xxhash64(F.lit(k), block(i), block(j)) for k, (i, j) in enumerate(combinations(range(n), 2))]
    return table.select("*", F.explode(F.array(*kept)).alias("cell"))


def _tiles(cells: DataFrame, tile_rows: int) -> DataFrame:
    """Cut cells above tile_rows into k tiles by fingerprint; a row goes to each pair of tiles that holds its own."""
    large = (cells.groupBy("cell").count().filter(F.col("count") > tile_rows)
             .select("cell", F.ceil(F.col("count") / tile_rows).cast("int").alias("k")))
    # staged, so that the join below is free to broadcast it by size or to split a skewed cell
    large, _ = stage(large, "simhash-large-cells")
    dealt = cells.join(large, "cell", "left").withColumn("k", F.coalesce("k", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("fp", F.lit(7)), "k").cast("int"))
    other = F.explode(F.when(F.col("k") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("k") - 1)))
    dealt = dealt.withColumn("other", other)
    return dealt.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("other", "k")


def _links(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Stars of the links within each (cell, lo, hi); rows come sorted by these."""
    kept: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        kept = table if kept is None else pa.concat_tables([kept, table])
        cell, lo, hi = (kept[c].to_numpy() for c in ("cell", "lo", "hi"))
        last = (cell == cell[-1]) & (lo == lo[-1]) & (hi == hi[-1])
        whole = int(np.argmax(last)) if len(last) else 0  # the last tile pair may go on in the next batch
        if whole:
            yield from _compare(kept.slice(0, whole), bits)
            kept = kept.slice(whole).combine_chunks()
    if kept is not None and kept.num_rows:
        yield from _compare(kept, bits)


def _compare(table: pa.Table, bits: int) -> Iterator[pa.RecordBatch]:
    cell, lo, hi, own = (table[c].to_numpy() for c in ("cell", "lo", "hi", "own"))
    fp = table["fp"].to_numpy()
    names = [c for c in table.column_names if c[0] == "d" and c[1:].isdigit()]
    dist = np.ascontiguousarray(np.stack([table[c].to_numpy() for c in names], 1)).view(np.uint8).astype(np.int8)
    starts = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
    sizes = np.diff(np.r_[starts, len(cell)])
    found: list[tuple[np.ndarray, np.ndarray]] = []
    # small cells together: the pairs at offset 1, 2, ... of all of them at once
    small = sizes <= 32
    small &= lo[starts] == hi[starts]
    end = np.repeat(np.where(small, starts + sizes, 0), sizes)
    at = np.arange(len(cell))
    for step in range(1, 32):
        a = at[at + step < end[at]]
        if not len(a):
            break
        found.append(_survivors(a, a + step, fp, dist, bits))
        at = a
    for s, n in zip(starts[~small], sizes[~small], strict=True):
        ids = np.arange(s, s + n)
        if lo[s] == hi[s]:
            left = right = ids
        else:
            left, right = ids[own[ids] == lo[s]], ids[own[ids] == hi[s]]
        for part in range(0, len(left), TILE_ROWS):
            rows = left[part:part + TILE_ROWS]
            a, b = np.repeat(rows, len(right)), np.tile(right, len(rows))
            if left is right:
                a, b = a[a < b], b[a < b]
            found.append(_survivors(a, b, fp, dist, bits))
    a = np.concatenate([f[0] for f in found]) if found else np.empty(0, np.int64)
    b = np.concatenate([f[1] for f in found]) if found else np.empty(0, np.int64)
    if len(a):
        root = _lowest(a, b, len(cell))
        node = np.flatnonzero(root != np.arange(len(cell)))
        # a row number is a fingerprint within one cell only, so stars never mix cells
        yield pa.RecordBatch.from_arrays([pa.array(fp[node]), pa.array(fp[root[node]])], ["a", "b"])


def _survivors(a: np.ndarray, b: np.ndarray, fp: np.ndarray, dist: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that no pivot coordinate discards and whose fingerprints are within bits."""
    for at in range(0, dist.shape[1], 4):
        if not len(a):
            break
        near = (np.abs(dist[a, at:at + 4] - dist[b, at:at + 4]) <= bits).all(1)
        a, b = a[near], b[near]
    near = np.bitwise_count((fp[a] ^ fp[b]).view(np.uint64)) <= bits
    return a[near], b[near]


def _lowest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest row reachable over the pairs, for each of n rows."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 3, id_col: str = "doc_id",
                    text_col: str = "text", tile_rows: int = TILE_ROWS) -> DataFrame:
    """(doc_id, row_key, fingerprint, component_id, root), a row per input row.

    component_id is the smallest doc_id reachable over links of at most ``bits``
    differing fingerprint bits. root, a fingerprint as signed long, names the
    component where doc_ids are null or repeated.
    """
    if not 0 <= bits <= 30:
        raise ValueError("bits must be between 0 and 30")
    marked, _ = stage(fingerprints(docs, shingle, id_col, text_col), "simhash")
    distinct, _ = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    table = pivot_table(distinct.select("fp"))
    rows = _tiles(_cells(table, bits), tile_rows)
    rows = rows.repartition("cell", "lo", "hi").sortWithinPartitions("cell", "lo", "hi")
    edges = rows.mapInArrow(lambda batches: _links(batches, bits), "a long, b long")
    edges, path = stage(edges, "simhash-links")
    found = connected_components(edges, "simhash-components")
    drop_stage(docs.sparkSession, path)
    # only linked fingerprints are in found; the others are their own group
    linked = distinct.join(found.withColumnRenamed("node", "fp"), "fp")
    groups = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_fp = linked.join(groups, "root").select("fp", "root", "component_id")
    of_fp = (distinct.join(of_fp, "fp", "left")
             .select("fp", F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("component_id"))
                     .alias("component_id"), F.coalesce("root", "fp").alias("root")))
    # staged, so that both sides of the last join are exchanged and a fingerprint with many copies can be split
    of_fp, _ = stage(of_fp, "simhash-groups")
    return marked.join(of_fp, "fp").select(
        "doc_id", "row_key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root")
