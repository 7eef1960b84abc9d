from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import functions as F

from eventmart.llm import lang_rank as lr
from tests.llm.cases import awkward, documents


def plain_grams(text):
    letters = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text)
    out: Counter = Counter()
    padded = " " + re.sub(" +", " ", letters).strip() + " "
    if not padded.strip():
        return out
    for n in (1, 2, 3):
        for i in range(len(padded) - n + 1):
            g = padded[i:i + n]
            if (n == 1 and g != " ") or n == 2 or (n == 3 and g[1] != " "):
                out[g] += 1
    return out


def code(gram):
    out = 0
    for c in gram:
        out = out << 21 | (1 if c == " " else ord(c))
    return out


def plain_profile(counts, size):
    return [g for _, g in sorted((-n, code(g)) for g, n in counts.items())[:size]]


def plain_predict(text, profiles, size):
    own = plain_profile(plain_grams(text or ""), size)
    if not own or not profiles:
        return "und", 0.0
    rank = {lang: {g: r for r, g in enumerate(p)} for lang, p in profiles.items()}
    apart = {lang: sum(abs(ranks[g] - r) if g in ranks else size for r, g in enumerate(own)) for lang, ranks in rank.items()}
    best = min(sorted(apart), key=apart.get)
    return best, 1 - apart[best] / (size * len(own))


def test_profiles_and_predictions_by_hand(spark):
    rows = awkward()
    docs = documents(spark, rows)
    for size in (5, 300):
        counts: dict = {}
        for _, t, lang, _ in rows:
            if t is not None and lang is not None:
                counts.setdefault(lang, Counter()).update(plain_grams(t))
        want = {lang: plain_profile(c, size) for lang, c in counts.items()}
        got = lr.learn(docs, size)
        assert got == want
        found = lr.identify(docs, got, size).collect()
        assert len(found) == len(rows)
        for r in found:
            lang, score = plain_predict(r["text"], want, size)
            assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-12, r["text"]


def test_columns_stay_and_clashing_ones_are_replaced(spark):
    docs = documents(spark, [(1, "abc")]).withColumn("found", F.lit(3)).withColumn("lang_pred", F.lit("old"))
    out = lr.identify(docs, {"xx": [code("a")]})
    assert sorted(out.columns) == sorted([*docs.columns])  # score and lang_pred are both there already
    assert out.first()["lang_pred"] == "xx" and out.first()["found"] == 3


def test_nothing_learned_and_empty_table(spark):
    docs = documents(spark, [(1, "abc"), (2, None), (3, "12 !")])
    assert lr.learn(docs) == {}
    assert {r["lang_pred"] for r in lr.identify(docs, {}).collect()} == {"und"}
    assert lr.identify(documents(spark, []), {"xx": [1]}).count() == 0
    assert {r["lang_pred"] for r in lr.identify(docs.filter("doc_id > 1"), {"xx": [code("a")]}).collect()} == {"und"}


def test_held_out_accuracy_and_fold(spark):
    import zlib

    from eventmart.llm.queries import op6_language_id

    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op6_language_id(spark, sf).collect()
    assert len(got) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(lang[r["doc_id"]] == r["lang_pred"] for r in held) / len(held) >= 0.97
