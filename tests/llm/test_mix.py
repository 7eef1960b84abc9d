from __future__ import annotations

import heapq
import re
from fractions import Fraction

from hypothesis import HealthCheck, given, settings, strategies as st

from eventmart.llm import apportion
from tests.llm.cases import awkward, documents


def plain_seats(weights, seats):
    """Sainte-Lague seat by seat."""
    won = dict.fromkeys(weights, 0)
    heap = [(-Fraction(w), k) for k, w in weights.items() if w > 0]
    heapq.heapify(heap)
    for _ in range(seats if heap else 0):
        _, k = heapq.heappop(heap)
        won[k] += 1
        heapq.heappush(heap, (-Fraction(weights[k]) / (2 * won[k] + 1), k))
    return won


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.lists(st.integers(0, 2000), min_size=1, max_size=12), st.integers(0, 400)), min_size=1, max_size=6))
def test_apportionment_seat_by_seat(spark, groups):
    rows = [(g, k, w, seats) for g, (weights, seats) in enumerate(groups) for k, w in enumerate(weights)]
    df = spark.createDataFrame(rows, "g int, k int, w long, seats long")
    got = {(r["g"], r["k"]): r["quota"] for r in apportion.sainte_lague(df, ["g"], "k", "w", "seats", "quota").collect()}
    for g, (weights, seats) in enumerate(groups):
        assert {k: got[g, k] for k in range(len(weights))} == plain_seats(dict(enumerate(weights)), seats)


def plain_targets(sizes, share=1.5):
    """Targets by resharing the excess until no source is above twice its size."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, target = Fraction(share) * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not full:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in full:
            target[s] = Fraction(2 * sizes[s])
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, got, block, tolerance):
    assert len(got) == len(rows)
    sizes: dict = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + words(t)
    target = plain_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - float(target[r["source"]])) <= 1e-9 * max(1, r["target"])
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= tolerance + block, (s, taken[s], float(target[s]))
    assert sorted((r["doc_id"] or -1, r["size"]) for r in got) == sorted((i or -1, words(t)) for i, t, *_ in rows)


def test_awkward_rows_and_reruns(spark):
    rows = awkward(2)
    docs = documents(spark, rows)
    got = apportion.mix(docs, block=8).collect()
    check(rows, got, 8, 8)
    again = apportion.mix(docs.repartition(5), block=8).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_many_shards(spark):
    rows = [(i, "w " * (i % 90), None, "hot" if i % 3 else f"s{i % 5}") for i in range(900)]
    check(rows, apportion.mix(documents(spark, rows), shard_words=500).collect(), 64, 64 * 60)


def test_no_words_and_empty_table(spark):
    got = apportion.mix(documents(spark, [(1, None), (2, " ", None, "a")])).collect()
    assert {(r["size"], r["target"], r["taken"]) for r in got} == {(0, 0.0, 0)}
    assert apportion.mix(documents(spark, [])).count() == 0


def test_main_path_is_native(spark):
    """No Python operator in the plan."""
    plan = apportion.mix(documents(spark, awkward()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_query_on_the_small_table(spark):
    from eventmart.llm.queries import op7_source_mix

    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    source = {r[0]: r[3] for r in rows}
    got = [r.asDict() | {"source": source[r["doc_id"]]} for r in op7_source_mix(spark, sf).collect()]
    check(rows, got, 64, 64)
