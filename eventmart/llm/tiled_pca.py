"""Embedding near-duplicates by PCA-ordered tiled comparison.

1. ``_classes``: equal vectors of a label collapse to one row with a count, so a
   vector with many copies is one row from here on.
2. ``fit_rotation``: the principal axes of at most ``SAMPLE`` unit vectors per
   dimension; any rotation keeps cosines, the axes only decide how soon a
   comparison can stop.
3. Unit vectors are rotated and dealt to tiles of about ``tile_rows`` rows:
   by their leading coordinate in steps of the largest distance two linked
   vectors can have, then by a hash. Only tiles of equal or neighbouring steps
   meet, and those whose bounding boxes on the leading coordinates lie further
   apart than that distance are never compared.
4. A pair of tiles is compared in blocks of leading dimensions: the product so
   far plus the product of the remaining lengths bounds the cosine from above;
   pairs whose bound falls below the threshold are left. Survivors are
   verified by their cosine in double precision on the original components.
5. A pair of tiles hands on link counts and a star per connected group, never
   its links one by one; ``connected_components`` joins the stars.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components, and rows with a null label, link with nothing; vectors of different
dimensions never link; repeated rows count as other vectors; null vec_ids are
never a component's smallest; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from eventmart.llm.common import connected_components, drop_stage, stage

THRESHOLD = 0.93
SAMPLE = 4096
TILE_ROWS = 1024
#: leading coordinates of the bounding boxes
BOX = 4
#: dimensions after which pairs are dropped, in shares of all
STOPS = (0.125, 0.25, 0.5, 1.0)
#: slack of the bounds against rounding
SLACK = 1e-9


def fit_rotation(sample: np.ndarray) -> np.ndarray:
    """Orthonormal matrix whose columns are the principal axes, largest first."""
    _, axes = np.linalg.eigh(sample.T @ sample)
    return np.ascontiguousarray(axes[:, ::-1])


def _classes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(all rows with their class, the classes): a class is a distinct usable vector of a label."""
    x = F.col("v")
    usable = (F.col("label").isNotNull() & x.isNotNull() & (F.size(x) > 0)
              & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
              & F.exists(x, lambda c: c != 0))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    # + 0.0 makes -0.0 equal 0.0
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False))).withColumn(
        "v", F.when(F.col("usable"), F.transform("v", lambda c: c + F.lit(0.0))))
    rows = rows.withColumn("digest", F.when(F.col("usable"), F.sha2(F.to_json(F.struct("label", "v")), 256)))
    rows, _ = stage(rows, "pca-vectors")
    classes = (rows.filter("usable").groupBy("digest")
               .agg(F.first("label").alias("label"), F.first("v").alias("v"), F.count("*").alias("n"), F.min("vec_id").alias("first_id"))
               .withColumn("node", F.monotonically_increasing_id()))
    return rows, stage(classes, "pca-classes")[0]


def _rotations(classes: DataFrame, sample: int) -> dict[int, np.ndarray]:
    """Dimension -> rotation, each from at most sample vectors (smallest digests)."""
    out = {}
    for row in classes.groupBy(F.size("v").alias("d")).count().collect():  # a row per dimension
        d = row["d"]
        drawn = classes.filter(F.size("v") == d).orderBy("digest").limit(max(d, min(sample, 4_000_000 // d))).select("v").collect()
        x = np.array([r["v"] for r in drawn])
        x = x / np.abs(x).max(1, keepdims=True)
        out[d] = fit_rotation(x / np.linalg.norm(x, axis=1, keepdims=True))
    return out


def _rotated(classes: DataFrame, rotations: dict[int, np.ndarray]) -> DataFrame:
    """classes with raw and rot (components as bytes, rot of the unit vector) and the leading coordinates."""
    shared = classes.sparkSession.sparkContext.broadcast(rotations)

    @pandas_udf("raw binary, rot binary, head array<double>")
    def rotate(vectors: pd.Series) -> pd.DataFrame:
        out = []
        for v in vectors:
            x = np.array(v, float)
            x = np.ldexp(x, -np.frexp(np.abs(x).max())[1])  # exact, and squares neither overflow nor vanish
            r = (x / np.linalg.norm(x)) @ shared.value[len(x)]
            head = np.zeros(BOX)
            head[:len(r)] = r[:BOX]
            out.append((x.tobytes(), r.tobytes(), head))
        return pd.DataFrame(out, columns=["raw", "rot", "head"])

    return classes.withColumn("r", rotate("v")).select("node", "n", "label", F.size("v").alias("d"), "r.raw", "r.rot", "r.head")


def _tiles(rows: DataFrame, reach: float, tile_rows: int) -> DataFrame:
    """rows with the column tile, unique over all labels and dimensions."""
    rows = rows.withColumn("step", F.floor(F.element_at("head", 1) / reach).cast("int"))
    cells = rows.groupBy("label", "d", "step").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("k"))
    cells, _ = stage(cells, "pca-cells")      # a row per step
    cut = F.pmod(F.xxhash64("rot"), F.col("k")).cast("int")
    return rows.join(cells, ["label", "d", "step"]).withColumn("tile", F.struct("label", "d", "step", cut.alias("cut"))).drop("k", "step")


def _tile_pairs(tiles: DataFrame, reach: float) -> tuple[DataFrame, str]:
    """(tile, tile2): every pair of tiles of a label whose boxes are within reach, from tile boxes only; staged.

    Vectors two steps apart are out of reach, so a tile is joined with those of its
    own step and of the next one, not with all of its label.
    """
    box = tiles.groupBy("tile").agg(
        F.array(*[F.min(F.element_at("head", i + 1)) for i in range(BOX)]).alias("lo"),
        F.array(*[F.max(F.element_at("head", i + 1)) for i in range(BOX)]).alias("hi"))
    box, path = stage(box.select("tile", "tile.label", "tile.d", "tile.step", "lo", "hi"), "pca-boxes")
    other = box.select(F.col("tile").alias("tile2"), "label", "d", "step", F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    steps = F.explode(F.array(F.col("step"), F.col("step") + 1)).alias("step")
    gap = sum((F.pow(F.greatest(F.col("lo")[i] - F.col("hi2")[i], F.col("lo2")[i] - F.col("hi")[i], F.lit(0.0)), F.lit(2.0))
               for i in range(BOX)), F.lit(0.0))
    near = (box.select("tile", "label", "d", steps, "lo", "hi").join(other, ["label", "d", "step"])
            .filter((F.col("tile") <= F.col("tile2")) & (gap <= reach * reach + SLACK)))
    out = stage(near.select("tile", "tile2"), "pca-tile-pairs")
    drop_stage(tiles.sparkSession, path)
    return out


def linked_pairs(raw_a: np.ndarray, rot_a: np.ndarray, raw_b: np.ndarray, rot_b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (in a, in b) of all pairs whose cosine reaches threshold."""
    d = rot_a.shape[1]
    stops = sorted({max(1, round(s * d)) for s in STOPS})
    done, a, b = 0, None, None
    total: np.ndarray | float = 0.0
    for stop in stops:
        rest_a = np.sqrt((rot_a[:, stop:] ** 2).sum(1))
        rest_b = np.sqrt((rot_b[:, stop:] ** 2).sum(1))
        if a is None:
            total = total + rot_a[:, done:stop] @ rot_b[:, done:stop].T
            alive = total + rest_a[:, None] * rest_b[None, :] >= threshold - SLACK
            if stop == stops[-1] or alive.mean() < 0.1:  # few are left: go on pair by pair
                a, b = np.nonzero(alive)
                total = total[a, b]
        else:
            total = total + np.einsum("ij,ij->i", rot_a[a, done:stop], rot_b[b, done:stop])
            alive = total + rest_a[a] * rest_b[b] >= threshold - SLACK
            a, b, total = a[alive], b[alive], total[alive]
        done = stop
    norm_a, norm_b = np.sqrt((raw_a * raw_a).sum(1)), np.sqrt((raw_b * raw_b).sum(1))
    found = []
    for at in range(0, len(a), 65536):
        i, j = a[at:at + 65536], b[at:at + 65536]
        found.append(np.einsum("ij,ij->i", raw_a[i], raw_b[j]) / (norm_a[i] * norm_b[j]) >= threshold)
    keep = np.concatenate(found) if found else np.empty(0, bool)
    return a[keep], b[keep]


def _stars(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row the smallest node it reaches over the links a-b."""
    root = nodes.copy()
    while len(a):
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        if (root == before).all():
            break
    return root


def _compare(left: pd.DataFrame, right: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """(node, n_links, root) over one pair of tiles; left is right for a tile with itself."""
    def matrix(column: pd.Series) -> np.ndarray:
        return np.frombuffer(b"".join(column), float).reshape(len(column), -1)

    right = right.rename(columns=lambda c: c.removesuffix("_b"))
    same = bool(left["same"].iloc[0]) if len(left) else False
    if not len(left) or not len(right):
        return pd.DataFrame({"node": [], "n_links": [], "root": []}, dtype="int64")
    a, b = linked_pairs(matrix(left["raw"]), matrix(left["rot"]), matrix(right["raw"]), matrix(right["rot"]), threshold)
    if same:  # both sides hold the same rows, but not in the same order
        differ = left["node"].to_numpy()[a] != right["node"].to_numpy()[b]
        a, b = a[differ], b[differ]
    n_left, n_right = left["n"].to_numpy(), right["n"].to_numpy()
    links = [np.bincount(a, n_right[b], len(left)).astype(np.int64), np.bincount(b, n_left[a], len(right)).astype(np.int64)]
    nodes = np.concatenate([left["node"].to_numpy(), right["node"].to_numpy()])
    order = np.unique(nodes)
    at = np.searchsorted(order, nodes)
    root = _stars(order, at[a], at[len(left) + b])
    if same:
        links[1][:] = 0  # each pair was seen from both ends on the left already
    out = pd.DataFrame({"node": nodes, "n_links": np.concatenate(links), "root": root[at]})
    return out[(out["n_links"] > 0) | (out["root"] != out["node"])]


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", sample: int = SAMPLE, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row per input row. Links need equal labels and a cosine of threshold."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    spark = vectors.sparkSession
    rows, classes = _classes(vectors, id_col, vector_col, label_col)
    reach = math.sqrt(2 - 2 * threshold) + 1e-6
    rotated, rotated_path = stage(_rotated(classes, _rotations(classes, sample)), "pca-rotated")
    tiles, tiles_path = stage(_tiles(rotated, reach, tile_rows), "pca-tiles")
    drop_stage(spark, rotated_path)
    pairs, pairs_path = _tile_pairs(tiles, reach)
    vectors_of = tiles.select("tile", "node", "n", "raw", "rot")
    left = pairs.join(vectors_of, "tile").withColumn("same", F.col("tile") == F.col("tile2"))
    other = pairs.select(F.col("tile").alias("tile_b"), F.col("tile2").alias("tile2_b"))
    right = other.join(vectors_of.select(F.col("tile").alias("tile2_b"), *[F.col(c).alias(f"{c}_b") for c in ("node", "n", "raw", "rot")]), "tile2_b")
    found = (left.groupBy("tile", "tile2").cogroup(right.groupBy("tile_b", "tile2_b"))
             .applyInPandas(lambda a, b: _compare(a, b, threshold), "node long, n_links long, root long"))
    found, path = stage(found, "pca-links")
    drop_stage(spark, tiles_path)
    drop_stage(spark, pairs_path)
    components = connected_components(found.filter("root <> node").select(F.col("node").alias("a"), F.col("root").alias("b")), "pca-components")
    links = found.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    linked = classes.select("digest", "node", "n", "first_id").join(links, "node", "left").join(components, "node", "left")
    linked = linked.withColumn("root", F.coalesce("root", "node"))
    # a vec_id may be null or repeated, so groups are named by their node until here
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    answers = linked.join(smallest, "root").select(
        "digest", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    answers, _ = stage(answers, "pca-answers")  # so that the join can split a vector with many copies
    drop_stage(spark, path)
    out = rows.select("vec_id", "digest").join(answers, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
