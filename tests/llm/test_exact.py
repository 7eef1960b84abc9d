from __future__ import annotations

import hashlib

import pytest

from eventmart.llm import grace_dedup as gd
from tests.llm.cases import awkward, documents


def normal(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


def plain(rows):
    """(doc_id, keep_id, size, digest) of each row and the number of rows kept."""
    groups: dict = {}
    for i, t, *_ in rows:
        groups.setdefault(normal(t), []).append((-len(t or ""), i is None, i or 0))
    out = []
    for i, t, *_ in rows:
        best = min(groups[normal(t)])
        out.append((i, None if best[1] else best[2], len(groups[normal(t)]), hashlib.sha256(normal(t).encode()).hexdigest()))
    return sorted(out, key=repr), len(groups)


def check(rows, got):
    want, kept = plain(rows)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=repr) == want
    keepers = [r for r in got if r["kept"]]
    assert len(keepers) == kept == len({r["text_sha256"] for r in keepers})
    assert all(r["doc_id"] == r["keep_id"] for r in keepers)


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def same_hash(content: bytes) -> bytes:
    return b"\0" * 8


def poor_hash(content: bytes) -> bytes:
    return bytes([len(content) % 3] * 8)


def test_matches_plain_groups(spark):
    rows = awkward(3)
    check(rows, gd.exact_duplicates(documents(spark, rows)).collect())


def test_recursion_over_small_batches(spark, small_batches):
    rows = awkward(4)
    check(rows, gd.exact_duplicates(documents(spark, rows), table_bytes=2000, fan_out=3).collect())


def test_colliding_hashes_are_told_apart_and_salted(spark, small_batches):
    rows = awkward(5, n=30)
    for hash_of in (same_hash, poor_hash):
        check(rows, gd.exact_duplicates(documents(spark, rows), table_bytes=20_000, max_levels=1, hash_of=hash_of).collect())


def test_one_text_larger_than_a_table_in_many_batches(spark, small_batches):
    rows = [(i, "copy " * 2000) for i in range(60)] + [(100, "single " * 3000)]
    check(rows, gd.exact_duplicates(documents(spark, rows), table_bytes=1000, max_levels=2).collect())


def test_empty_table(spark):
    assert gd.exact_duplicates(documents(spark, [])).count() == 0


def test_open_addressing_compares_contents():
    table = gd.OpenTable(4)
    assert [table.number(5, c) for c in (b"a", b"b", b"a", b"c", b"b")] == [0, 1, 0, 2, 1]
