from __future__ import annotations

import math
import random

import numpy as np
import pytest

from eventmart.llm import tiled_pca
from tests.llm.cases import groups

SCHEMA = "vec_id long, embedding array<float>, label int, tile string, node long, digest string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, "d") for r in rows], SCHEMA)


def plain(rows, threshold=0.93):
    """n_links and component of each row by comparing all pairs."""
    usable = [lab is not None and v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v) and any(v)
              for _, v, lab in rows]
    x = [np.array([float(np.float32(c)) for c in v]) if ok else None for ok, (_, v, _) in zip(usable, rows, strict=True)]
    links = []
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            if usable[i] and usable[j] and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]):
                if x[i] @ x[j] / (math.sqrt(x[i] @ x[i]) * math.sqrt(x[j] @ x[j])) >= threshold:
                    links.append((i, j))
    n = [0] * len(rows)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    root, smallest = groups(range(len(rows)), links), {}
    for i, (vec_id, *_) in enumerate(rows):
        if vec_id is not None:
            smallest[root[i]] = min(smallest.get(root[i], vec_id), vec_id)
    return sorted(((r[0], n[i], smallest.get(root[i]), r[0] is not None and r[0] == smallest.get(root[i])) for i, r in enumerate(rows)), key=repr)


def rows_of(seed=0, n=160, d=12):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    for label in (0, 1, 2):
        for _ in range(n // 12):
            centre = rng.normal(size=d)
            for _ in range(4):
                k += 1
                rows.append((k, (centre + rng.normal(size=d) * rng.choice([0.05, 0.2, 0.4])).tolist(), label))
    copy = rows[5][1]
    rows += [(1000 + i, copy, 0) for i in range(40)]                        # one vector very often
    rows += [(2000, [2 * c for c in copy], 0), (2001, [-c for c in copy], 0), (2002, copy, 1), (2003, copy, None)]
    rows += [(3000, None, 0), (3001, [], 0), (3002, [0.0] * d, 0), (3003, [None] + [1.0] * (d - 1), 0), (3004, [math.nan] * d, 0),
             (3005, [math.inf] + [1.0] * (d - 1), 0), (3006, copy[:3], 0), (3007, copy[:3], 0), (None, copy, 2), (None, [9.0] * d, 2),
             (rows[0][0], rows[0][1], 0), (rows[0][0], copy, 0), (3008, [1e-30] * d, 2), (3009, [1e30] * d, 2), (3010, [-0.0] * d, 0),
             (3011, [5.0], 1), (3012, [7.0], 1)]
    random.Random(1).shuffle(rows)
    return rows


@pytest.mark.parametrize("tile_rows", [tiled_pca.TILE_ROWS, 4])
def test_matches_all_pairs(spark, tile_rows):
    rows = rows_of()
    got = tiled_pca.near_duplicates(vectors(spark, rows), tile_rows=tile_rows).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(rows)


def test_early_stops_lose_no_pair():
    rng = np.random.default_rng(2)
    for d in (1, 2, 5, 64):
        x = rng.normal(size=(300, d)) * np.linspace(3, 0.1, d) + rng.normal(size=d)
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        rotated = unit @ tiled_pca.fit_rotation(unit[:100])
        for threshold in (0.5, 0.93, 0.999):
            a, b = tiled_pca.linked_pairs(x[:200], rotated[:200], x[200:], rotated[200:], threshold)
            norm = np.sqrt((x * x).sum(1))
            want = (x[:200] @ x[200:].T) / (norm[:200, None] * norm[None, 200:])
            sure = np.abs(want - threshold) > 1e-12
            got = np.zeros_like(want, bool)
            got[a, b] = True
            assert (got == (want >= threshold))[sure].all()


def test_empty_and_unusable_tables(spark):
    assert tiled_pca.near_duplicates(vectors(spark, [])).count() == 0
    got = tiled_pca.near_duplicates(vectors(spark, [(1, None, 0), (2, [1.0], None)])).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 1, True), (2, 0, 2, True)]
    with pytest.raises(ValueError):
        tiled_pca.near_duplicates(vectors(spark, []), threshold=0)


def test_tiles_meet_those_of_their_own_and_the_next_step_only(spark):
    """Vectors along a line of many steps: every pair within reach is there, pairs two steps apart never meet."""
    from pyspark.sql import functions as F

    reach = 0.1
    heads = [(0, 8, float(x) / 40, [x / 40, (x % 3) / 50, 0.0, 0.0], str(x).encode()) for x in range(-40, 41)]
    rows = spark.createDataFrame([(lab, d, h, r) for lab, d, _, h, r in heads], "label int, d int, head array<double>, rot binary")
    tiles = tiled_pca._tiles(rows, reach, 2)
    pairs, _ = tiled_pca._tile_pairs(tiles, reach)
    got = {(tuple(p.tile), tuple(p.tile2)) for p in pairs.collect()}
    assert got and all(0 <= b[2] - a[2] <= 1 for a, b in got)
    tile_of = {tuple(r["head"]): tuple(r["tile"]) for r in tiles.select("head", F.col("tile")).collect()}
    points = list(tile_of)
    for p in points:
        for q in points:
            if math.dist(p, q) <= reach:
                assert tuple(sorted((tile_of[p], tile_of[q]))) in got
