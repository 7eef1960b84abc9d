from __future__ import annotations

import pytest

import corpus_pipeline as cp
from eventmart.llm.simhash_pivots import simhash
from tests.llm.cases import awkward, documents
from tests.llm.test_exact import plain as plain_exact
from tests.llm.test_simhash import plain_components

STAGE = dict(cp.STAGES)


def test_stage_names():
    assert [n for n, _ in cp.STAGES] == ["language", "exact_dedup", "near_dedup", "source_mix", "packing"]


@pytest.fixture
def docs(spark):
    return documents(spark, awkward(6))


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES[:-1]])
def test_columns_and_empty_input(spark, docs, name):
    out = STAGE[name](spark, docs, "")
    assert out.columns == docs.columns
    assert STAGE[name](spark, docs.limit(0), "").count() == 0


def test_language_rejects_texts_without_letters_only(spark, docs):
    got = STAGE["language"](spark, docs, "").collect()
    want = [r for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_language_keeps_short_clean_texts(spark):
    """However little a text has in common with the profiles, a letter is enough."""
    learnt = [(i, "the quick brown fox jumps over the lazy dog again and again", "en") for i in range(40)]
    short = [(1000 + i, t) for i, t in enumerate(["À", "Zoë", "Fluffy puppy", "ß", "𝒳", "Ça", "日本", "1 2 x"])]
    got = STAGE["language"](spark, documents(spark, [*learnt, *short, (2000, "12 !"), (2001, None)]), "").collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, *_ in [*learnt, *short])


def test_a_cut_copy_keeps_its_line_breaks(spark):
    text = "one\n two\tthree  four\n\nfive six"
    rows = [(i, text, "en", "a") for i in range(60)] + [(100, "x " * 500, "en", "b")]
    got = [r["text"] for r in STAGE["source_mix"](spark, documents(spark, rows), "").collect() if r["doc_id"] < 100]
    assert text in got and len(set(got)) > 1 and all(text.startswith(t) for t in got)


def test_exact_keeps_the_stated_row(spark, docs):
    got = STAGE["exact_dedup"](spark, docs, "").collect()
    rows = awkward(6)
    answers, groups = plain_exact(rows)
    assert len(got) == groups
    assert {r["doc_id"] for r in got} == {a[1] for a in answers}


def test_near_keeps_one_of_each_group(spark, docs):
    got = STAGE["near_dedup"](spark, docs, "").collect()
    want = {a[2] for a in plain_components(awkward(6)) if a[2] is not None}
    ids = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert set(ids) == want and len(ids) == len(want)


def test_near_keeps_one_row_of_each_group_whatever_the_ids(spark):
    """One id on two unrelated texts, and linked near copies without an id."""
    base = [f"word{i}" for i in range(3000)]
    near = [" ".join(base[:k] + ["changed"] + base[k + 1:]) for k in (5, 700, 1400, 2100)]
    prints = [simhash(t, 3) for t in near]
    assert len(set(prints)) > 1 and all((prints[0] ^ p).bit_count() <= 3 for p in prints)
    rows = [(5, "alpha beta gamma delta"), (5, "one two three four five"), (6, "one two three four five"), *[(None, t) for t in near]]
    got = [(r["doc_id"], r["text"]) for r in STAGE["near_dedup"](spark, documents(spark, rows), "").collect()]
    assert sorted(t for i, t in got if i == 5) == ["alpha beta gamma delta", "one two three four five"]
    assert len(got) == 3 and sum(i is None for i, _ in got) == 1


def test_mix_repeats_and_cuts_texts(spark, docs):
    got = STAGE["source_mix"](spark, docs, "").collect()
    taken: dict = {}
    for r in cp.apportion.mix(docs).collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["taken"]
    seen: dict = {}
    for r in got:
        n = len([w for w in r["text"].replace("\n", " ").split(" ") if w])
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + n
        assert r["n_chars"] == len(r["text"])
    assert seen == {k: v for k, v in taken.items() if v}


def test_run(spark):
    sf = "/root/testdata/sf0.001"
    got = cp.run(spark, sf)
    assert got.columns == ["doc_id", "n_tokens", "bucket", "bucket_len", "batch", "slot", "padding"]
    rows = got.collect()
    assert 0 < len({r["doc_id"] for r in rows}) < spark.read.parquet(f"{sf}/documents.parquet").count()
