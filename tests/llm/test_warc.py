from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from eventmart.llm import warc_merkle as wm

SCHEMA = "page_id long, url string, html string, shard string, offset int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def some_pages(n=300):
    rows = [(i, f"https://h{i % 7}.example/{i}", f"<p>{'é' * (i % 50)}{i}</p>") for i in range(n)]
    return rows + [(None, None, None), (None, None, None), (5, "https://h5.example/5", "other"), (7, rows[7][1], rows[7][2]), (400, "u", ""),
                   (401, "long", "z" * 300_000)]


def test_records_follow_each_other(spark):
    rows = some_pages()
    index = wm.archive(pages(spark, rows), shard_records=16).collect()
    assert sum(r["copies"] for r in index) == len(rows)
    by_shard: dict = {}
    for r in index:
        by_shard.setdefault(r["shard"], []).append(r)
    assert len(by_shard) > 10
    for records in by_shard.values():
        at = 0
        for r in sorted(records, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"] * r["copies"]
    page = {(i, u or ""): h or "" for i, u, h in rows if i not in (5, None)}
    for r in index:
        if (r["page_id"], r["url"]) in page:
            body = page[r["page_id"], r["url"]].encode()
            text = (f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{r['page_id']}>\r\nWARC-Target-URI: {r['url']}\r\n"
                    f"Content-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"
            assert (len(text), hashlib.sha256(text).hexdigest()) == (r["length"], r["record_sha256"])


def damaged(spark, rows, **sizes):
    bad, lost, extra = {3, 99, 250}, {40, 41, 299}, {17}
    stored = F.when(~F.coalesce(F.col("page_id").isin(*lost), F.lit(False)),
                    F.when(F.col("page_id").isin(*bad), F.concat(F.lit("#"), "html")).otherwise(F.coalesce("html", F.lit(""))))
    index = wm.archive(pages(spark, rows), stored, shard_records=64)
    first = index.filter(F.coalesce(~F.col("page_id").isin(*extra), F.lit(True))).drop("stored_sha256")
    second = index.filter("stored_sha256 is not null").drop("record_sha256").withColumnRenamed("stored_sha256", "record_sha256")
    return first, second, {**{i: "changed" for i in bad}, **{i: "missing" for i in lost}, **{i: "extra" for i in extra}}


def test_audit_locates_each_fault(spark):
    first, second, want = damaged(spark, some_pages())
    for sizes in ({}, {"range_bytes": 512, "fan_out": 2}, {"range_bytes": 1 << 30}):
        got = wm.audit(first, second, **sizes).collect()
        assert {r["page_id"]: r["fault"] for r in got} == want and len(got) == len(want)


def test_roots_by_hand(spark):
    first, _, _ = damaged(spark, some_pages(60))
    levels = wm.tree(first, 1024, 4)
    leaves: dict = {}
    for r in sorted(first.collect(), key=lambda r: r["offset"]):
        leaves.setdefault((r["shard"], r["offset"] // 1024), []).append(f"{r['offset']}:{r['length']}:{r['copies']}:{r['record_sha256']}")
    level = {k: hashlib.sha256(",".join(v).encode()).hexdigest() for k, v in leaves.items()}
    for df in levels:
        assert {(r["shard"], r["at"]): r["hash"] for r in df.collect()} == level
        up: dict = {}
        for (shard, at), h in sorted(level.items()):
            up.setdefault((shard, at // 4), []).append(f"{at}:{h}")
        level = {k: hashlib.sha256(",".join(v).encode()).hexdigest() for k, v in up.items()}
    assert {at for _, at in {(r["shard"], r["at"]) for r in levels[-1].collect()}} == {0}


def test_equal_and_empty_replicas(spark):
    index = wm.archive(pages(spark, some_pages(30)))
    none = wm.archive(pages(spark, []))
    assert wm.audit(index, index).count() == 0
    assert wm.audit(none, none).count() == 0
    assert {r["fault"] for r in wm.audit(index, none).collect()} == {"missing"}
    assert wm.audit(none, index).count() == index.count()
