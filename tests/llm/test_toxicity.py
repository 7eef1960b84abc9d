from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from eventmart.llm import toxic_neighbors as tn
from tests.llm.cases import awkward, documents

texts = st.dictionaries(st.integers(0, 7), st.integers(1, 4), max_size=5).map(lambda d: (sorted(d), [d[t] for t in sorted(d)]))


@settings(max_examples=120, deadline=None)
@given(st.lists(texts.filter(lambda t: t[0]), max_size=60), texts, st.integers(1, 8), st.integers(1, 9))
def test_block_max_search_is_exact(examples, query, k, block):
    weights = np.array([3.0, 0.5, 1.0, 2.0, 0.1, 1.0, 1.0, 4.0])
    index = tn.BlockMaxIndex([(100 + i, *e) for i, e in enumerate(examples)], weights, block, k)
    place, cosine = index.nearest(*query, k)

    def dense(terms, counts):
        v = np.zeros(8)
        v[terms] = [(1 + math.log(c)) * weights[t] for t, c in zip(terms, counts, strict=True)]
        return v / np.linalg.norm(v) if v.any() else v

    every = [(round(float(dense(*e) @ dense(*query)), 9), 100 + i) for i, e in enumerate(examples)]
    every = sorted((x for x in every if x[0] > 0), key=lambda x: (-x[0], x[1]))
    least = every[k - 1][0] if len(every) >= k else 0
    want = [x for x in every if x[0] >= least - 2e-9]
    got = list(zip(cosine.tolist(), index.ids[place].tolist(), strict=True))
    assert len(got) <= len(want) and [c for c, _ in got] == pytest.approx([c for c, _ in want[:len(got)]], abs=2e-9)
    assert {i for c, i in every if c > least + 2e-9} <= {i for _, i in got}
    if len(every) >= k:
        assert len(got) >= k


def labelled(spark, n=400):
    rng = random.Random(2)
    bad, plain = ["vilestem" + s for s in ("a", "en", "ung", "x")], ["house", "tree", "river", "stone", "cloud", "vile", "stem"]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=30)
        if i % 5 == 0:
            words[rng.randrange(30)] = rng.choice(bad).upper()
        rows.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, int(i % 5 == 0), "x"))
    labels += [(10, 0, "x"), (None, 1, "x"), (3, None, "x"), (5000, 1, "x")]  # labelled twice, no id, no label, no document
    return rows, spark.createDataFrame(labels, "doc_id long, toxic int, text string")


def test_scores_separate_and_carry_evidence(spark):
    rows, labels = labelled(spark)
    extra = [(900, None), (901, ""), (902, "!!!"), (0, "vilestemen"), (None, "vilestema tree")]
    got = tn.score(documents(spark, rows + extra), labels).collect()
    assert len(got) == len(rows) + len(extra)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        if r["doc_id"] is None:
            assert r["predicted"] == 1
        elif r["doc_id"] >= 900:
            assert r["predicted"] == 0 and r["evidence"] == ""
        elif r["doc_id"]:
            assert r["predicted"] == int(r["doc_id"] % 5 == 0), r
            assert not r["predicted"] or r["evidence"].split(":")[1] == "1"


def test_blocks_are_skipped_and_nothing_is_lost():
    """Examples of four vocabularies that share a few words: most blocks are never looked into."""
    rng = random.Random(5)
    weights = np.array([rng.uniform(0.5, 6) for _ in range(2000)])
    examples = []
    for i in range(2000):
        own = 20 + 495 * (i % 4)
        terms = sorted({*rng.sample(range(20), 8), *rng.sample(range(own, own + 495), 30)})
        examples.append((i, terms, [rng.randrange(1, 4) for _ in terms]))
    # the blocks hold all words in one index; in the other the block is all and only a few words are long lists
    index, whole = tn.BlockMaxIndex(examples, weights, 16, 2000), tn.BlockMaxIndex(examples, weights, 5000, 3)
    for _, terms, counts in rng.sample(examples, 60):
        some = sorted(rng.sample(terms, 30))
        query = (some, [counts[terms.index(t)] for t in some])
        place, cosine = index.nearest(*query, 2)
        far, want = whole.nearest(*query, 2)
        assert cosine.tolist() == pytest.approx(want.tolist(), abs=2e-9)
        assert index.ids[place[:1]].tolist() == whole.ids[far[:1]].tolist()
    assert whole.visited == whole.possible == 60
    assert index.visited < 0.5 * index.possible
    texts = [(t, c) for _, t, c in rng.sample(examples, 150)]
    for (place, cosine), text in zip(index.nearest_of(texts, 5), texts, strict=True):     # many at once
        alone, want = index.nearest(*text, 5)
        assert place.tolist() == alone.tolist() and cosine.tolist() == want.tolist()


def plain_scores(rows, labels, neighbors):
    """From texts to calibrated votes, step by step; ids and texts are unique."""
    tokens = {i: Counter(re.findall(r"[^\W\d_]+", (t or "").lower())) for i, t in rows}
    label = {i: t for i, t in labels if i in tokens}
    n1 = sum(label.values())
    n0, total = len(label) - n1, len(label)

    def tells(present):
        """G-squared and log odds of a set of known texts."""
        a, b = (sum(label[i] == k for i in present) for k in (1, 0))
        g2 = 2 * sum(s * math.log(s * total / (r * c)) for s, r, c in
                     ((a, a + b, n1), (b, a + b, n0), (n1 - a, total - a - b, n1), (n0 - b, total - a - b, n0)) if s)
        return round(g2, 6), abs(math.log((a + .5) * (n0 - b + .5) / ((b + .5) * (n1 - a + .5))))

    texts_of: dict = {}
    for i in label:
        for w in tokens[i]:
            for n in tn.BEGINNINGS:
                if len(w) > n:
                    texts_of.setdefault(w[:n], set()).add(i)
    stems = {p: g for p, present in texts_of.items() if (g := tells(present)[0]) >= tn.SIGNIFICANT}
    for c in tokens.values():
        own: Counter = Counter()
        for w, n in c.items():
            if best := sorted((-stems[w[:k]], -k, w[:k]) for k in tn.BEGINNINGS if len(w) > k and w[:k] in stems):
                own[f"^{best[0][2]}"] += n
        own.update({f"{p}@": n for p, n in list(own.items()) if n * tn.DENSE >= c.total()})
        c.update(own)
    known = {i: c for i, c in tokens.items() if i in label}
    weight = {}
    for w in {w for c in known.values() for w in c}:
        g2, odds = tells({i for i, c in known.items() if w in c})
        df = sum(w in c for c in tokens.values())
        weight[w] = math.log(1 + len(tokens) / df) * (1 + tn.ODDS_WEIGHT * odds if g2 >= tn.SIGNIFICANT else 1)

    def vector(c):
        v = {w: (1 + math.log(n)) * weight[w] for w, n in c.items() if w in weight}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / length for w, x in v.items()}

    vectors = {i: vector(c) for i, c in tokens.items()}

    def vote(i, left_out):
        near = sorted(((-round(sum(x * vectors[e].get(w, 0) for w, x in vectors[i].items()), 9), e) for e in known if not (left_out and e == i)))
        near = [x for x in near if x[0] < 0]
        cut = near[neighbors - 1][0] if len(near) > neighbors else 0
        near = [x for x in near if x[0] <= cut]
        shares = [(1 / (tn.NEAREST + 1 - min(-c, 1)), label[e], c) for c, e in near]
        tied = [s for s in shares if s[2] == cut] if len(near) > neighbors else []
        part = (neighbors - (len(shares) - len(tied))) / len(tied) if tied else 1
        shares = [(w * (part if c == cut and tied else 1), t) for w, t, c in shares]
        return (sum(w * t for w, t in shares) + tn.SHRINK * n1 / total) / (sum(w for w, _ in shares) + tn.SHRINK)

    points = sorted([(vote(i, True), float(label[i])) for i in known if vectors[i]] + [(0.0, 0.0), (1.0, 1.0)])
    pools = [[[v], [t]] for v, t in points]
    again = True
    while again:            # neighbours that are equal or fall are pooled, until none is left
        again = False
        for k in range(len(pools) - 1):
            if pools[k][0][-1] == pools[k + 1][0][0] or np.mean(pools[k][1]) >= np.mean(pools[k + 1][1]):
                pools[k:k + 2] = [[pools[k][0] + pools[k + 1][0], pools[k][1] + pools[k + 1][1]]]
                again = True
                break
    blank = sum(1 for i in known if not vectors[i])
    rate_blank = (sum(label[i] for i in known if not vectors[i]) + tn.SHRINK * n1 / total) / (blank + tn.SHRINK)
    xs, ys = [np.mean(p[0]) for p in pools], [np.mean(p[1]) for p in pools]
    return {i: float(np.interp(vote(i, False), xs, ys)) if vectors[i] else rate_blank for i in tokens}


def test_scores_from_texts_by_hand(spark):
    rng = random.Random(8)
    plain = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in "lmnr"]
    endings = ["", "en", "ung", "ulich"]
    rows, labels = [], []
    for i in range(160):
        words = rng.choices(plain, k=rng.randrange(3, 25)) + [rng.choice(["vilus", "MORBUS"]) + rng.choice(endings) for _ in range(2)] * (i % 4 == 0)
        rng.shuffle(words)
        rows.append((i, " ".join(words) + rng.choice(["", ".", " 42", "_x"])))
        if i % 3:
            labels.append((i, int(i % 4 == 0)))
    rows += [(500, "vilus"), (504, "vilusque"), (505, " ".join(plain * 4) + " morbusque"), (501, ""), (502, "nothing known here"), (503, rows[7][1])]
    labels += [(501, 0)]
    got = {r["doc_id"]: r["score"] for r in tn.score(
        documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"), neighbors=6).collect()}
    want = plain_scores(rows, labels, 6)
    assert got.keys() == want.keys()
    for i, s in want.items():
        assert abs(got[i] - s) < 1e-6, (i, got[i], s)


def test_of_several_texts_under_one_id_one_is_the_example(spark):
    rows = [(i, f"word{chr(97 + i % 26)} other{chr(97 + i // 26)}") for i in range(60)] + [(1, "quite different words"), (1, None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    docs = documents(spark, rows)
    once = sorted((r["doc_id"], r["score"], r["evidence"]) for r in tn.score(docs, labels).collect())
    again = sorted((r["doc_id"], r["score"], r["evidence"]) for r in tn.score(docs.repartition(5), labels).collect())
    assert once == again


def test_copy_of_an_example_without_a_telling_word(spark):
    """Words that no label test admits still find the very example."""
    rng = random.Random(4)
    names = ["".join(rng.choices("bcdfglmnprstv", k=9)) for _ in range(400)]
    rows = [(i, " ".join(names[4 * i:4 * i + 4])) for i in range(100)]
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(100)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in tn.score(documents(spark, [*rows, (500, rows[6][1]), (501, rows[7][1])]), labels).collect()}
    assert got[500]["evidence"].startswith("6:1:1.0000") and got[501]["evidence"].startswith("7:0:1.0000")
    assert got[500]["score"] > 0.5 > got[501]["score"]


def test_one_long_text_does_not_take_the_terms_of_the_others(spark):
    """Many toxic words that are all in one example of small digest: each of them still tells."""
    bad = [f"{c}{d}vilus" for c in "bcdf" for d in "klm"]
    rng = random.Random(3)
    plain = ["house", "tree", "river", "stone", "cloud"]
    long = next(t for t in (" ".join(bad + rng.choices(plain, k=8)) for _ in iter(int, 1)) if zlib.crc32(t.encode()) < 2 ** 32 // 20_000)
    rows = [(0, long)] + [(i, " ".join(rng.choices(plain, k=20) + ([bad[i // 2 % 12]] if i % 2 else []))) for i in range(1, 600)]
    labels = [(0, 1)] + [(i, i % 2) for i in range(1, 600)]
    rows += [(1000 + i, f"house tree {w} river") for i, w in enumerate(bad)]
    got = tn.score(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")).filter("doc_id >= 1000").collect()
    assert len(got) == 12 and all(r["predicted"] == 1 for r in got)


def test_sample_bound(spark):
    _, labels = labelled(spark)
    examples, sizes = tn.sample_examples(labels, 7)
    assert sizes == [160, 41] and examples.groupBy("toxic").count().filter("count <= 7").count() == 2


def test_nothing_learned(spark):
    docs = documents(spark, awkward())
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    got = tn.score(docs, labels).collect()
    assert {(r["score"], r["predicted"], r["evidence"]) for r in got} == {(0.0, 0, "")} and len(got) == len(awkward())
    one = spark.createDataFrame([(100, 1)], "doc_id long, toxic int")
    assert tn.score(docs, one).count() == len(awkward())
    assert tn.score(documents(spark, []), one).count() == 0


def test_held_out_accuracy(spark):
    from eventmart.llm.queries import op9_toxicity

    sf = "/root/testdata/sf0.1"
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = op9_toxicity(spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [(r["predicted"], toxic[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in toxic]
    caught = sum(p for p, t in held if t)
    # about one label in twenty is on a text without any marked word
    assert caught / sum(t for _, t in held) >= 0.9
    assert sum(p for p, t in held if not t) <= 0.01 * sum(1 - t for _, t in held)
