from __future__ import annotations

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from eventmart.llm import simhash_pivots
from tests.llm.cases import awkward, documents, groups


def plain_fingerprint(text, shingle=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, bits=3):
    """Answers by comparing every pair of fingerprints."""
    fps = sorted({plain_fingerprint(t) for _, t, *_ in rows})
    links = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if (a ^ b).bit_count() <= bits]
    root = groups(fps, links)
    smallest: dict = {}
    for i, t, *_ in rows:
        r = root[plain_fingerprint(t)]
        if i is not None:
            smallest[r] = min(smallest.get(r, i), i)
    return sorted(((i, f"{plain_fingerprint(t):016x}", smallest.get(root[plain_fingerprint(t)])) for i, t, *_ in rows), key=repr)


def answers(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("tile_rows", [simhash_pivots.TILE_ROWS, 3])
def test_matches_all_pairs(spark, tile_rows):
    rows = awkward(1)
    got = simhash_pivots.near_duplicates(documents(spark, rows), tile_rows=tile_rows)
    assert answers(got) == plain_components(rows)


def test_spark_hash_is_the_contract_hash(spark):
    got = spark.sql("select xxhash64('one two three') as h").first()["h"]
    assert got & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"one two three", 42)


def test_links_of_given_fingerprints(spark):
    """Fingerprints at every distance around the limit, and a large cell of near ones."""
    rng = random.Random(5)
    fps = set()
    for _ in range(40):
        f = rng.getrandbits(64)
        fps.add(f)
        for k in (1, 2, 3, 4, 5):
            g = f
            for b in rng.sample(range(64), k):
                g ^= 1 << b
            fps.add(g)
    centre = rng.getrandbits(64)
    fps |= {centre ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20, 64)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    table = simhash_pivots.pivot_table(spark.createDataFrame([(f,) for f in signed], "fp long"))
    rows = simhash_pivots._tiles(simhash_pivots._cells(table, 3), 50)
    rows = rows.repartition("cell", "lo", "hi").sortWithinPartitions("cell", "lo", "hi")
    stars = rows.mapInArrow(lambda b: simhash_pivots._links(b, 3), "a long, b long").collect()
    mask = (1 << 64) - 1
    got = groups(fps, [(r["a"] & mask, r["b"] & mask) for r in stars])
    ordered = sorted(fps)
    want = groups(fps, [(a, b) for i, a in enumerate(ordered) for b in ordered[i + 1:] if (a ^ b).bit_count() <= 3])
    assert got == want


def test_pivot_distances(spark):
    row = simhash_pivots.pivot_table(spark.createDataFrame([(-5,), (12345,)], "fp long")).orderBy("fp").first()
    refs = simhash_pivots.reference_fingerprints()
    packed = b"".join((row[f"d{i}"] & (1 << 64) - 1).to_bytes(8, "little") for i in range(len(refs) // 8))
    assert list(packed) == [((-5 & (1 << 64) - 1) ^ r).bit_count() for r in refs]


def test_empty_table_and_bad_bits(spark):
    docs = documents(spark, [])
    assert simhash_pivots.near_duplicates(docs).count() == 0
    with pytest.raises(ValueError):
        simhash_pivots.near_duplicates(docs, bits=40)


def test_query_on_the_small_table(spark):
    from eventmart.llm.queries import op1_simhash_near_dedup

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert answers(op1_simhash_near_dedup(spark, sf)) == plain_components(rows)
