from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from eventmart.llm import source_audit as sa
from tests.llm.cases import awkward, documents

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_docs, top):
    rows = [(t or "", a or "", s or "") for _, t, a, s in rows]
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        terms = TERM.findall(text.translate(LOWER))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def p(count, kept=kept):
            total = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 5) // total for t in kept}

        ps, q = {s: p(counts[lang, s]) for s in sources}, p(whole)
        for s in sources:
            pairs = [(-sum(abs(ps[s][t] - ps[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(q[t] - ps[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and ps[s][t] > q[t]]
            out += [(lang, s, "pair", o, -v, r) for r, (v, _, o) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", t, -v, r) for r, (v, _, t) in enumerate(sorted(terms)[:top], 1)]
    return sorted(out)


def found(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect())


def many(n=400, n_sources=7):
    rng = random.Random(3)
    words = ["Ab", "aB", "ÉA", "éa", "x1y", "ß", "𝒳z", "don't", "tie", "eit"]
    out = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 30))), rng.choice(["en", "EN", "", None]), f"s{rng.randrange(n_sources)}")
           for i in range(n)]
    return out + [(1, "\x00\x7f 12 --", "none", "a"), (1, None, "none", "b"), (1, "lone", "one", None)] + out[:40]


@pytest.mark.parametrize("shard_rows,tile", [(sa.SHARD_ROWS, sa.TILE), (5, 2), (3, 3)])
def test_audit_by_hand(spark, shard_rows, tile):
    rows = many()
    got = found(sa.audit(documents(spark, rows), min_docs=5, top=4, shard_rows=shard_rows, tile=tile))
    assert got == plain(rows, 5, 4)


def test_awkward_rows_clashing_columns_and_empty_table(spark):
    rows = awkward()
    docs = documents(spark, rows).withColumn("term", F.lit("t")).withColumn("n", F.lit(9))
    assert found(sa.audit(docs, min_docs=2)) == plain(rows, 2, sa.TOP)
    assert sa.audit(documents(spark, [])).count() == 0
    alone = sa.audit(documents(spark, [(1, "a b", "en", "s"), (2, "", "en", "t")]))  # nothing kept
    assert found(alone) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_shares_are_exact_for_large_counts():
    import numpy as np

    rng = random.Random(1)
    for _ in range(500):
        total = rng.randrange(6, 2 * 10**14)
        count = rng.randrange(0, total - 5)
        assert int(sa._share(np.array([count]), total)[0]) == 1 + 10**9 * (count + 5) // total


def test_partial_counts_are_merged_and_flushed():
    import pyarrow as pa

    rows = pa.RecordBatch.from_pydict({"text": ["a b a", None, "B c"] * 10, "lang": ["x"] * 30, "source": ["s", "t", None] * 10})
    held, sa.HELD_ROWS = sa.HELD_ROWS, 2
    try:
        parts = list(sa._partial_counts(iter([rows, rows])))
    finally:
        sa.HELD_ROWS = held
    sums = Counter()
    for b in parts:
        for r in b.to_pylist():
            sums[r["source"], r["term"]] += r["n"]
    assert sums == {("s", "a"): 40, ("s", "b"): 20, ("", "b"): 20, ("", "c"): 20, ("s", ""): 0, ("t", ""): 0, ("", ""): 0}
