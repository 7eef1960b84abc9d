from __future__ import annotations

from collections import Counter

from tokenizers import Tokenizer

from eventmart.llm import token_histogram as th
from tests.llm.cases import awkward, documents


def plain_lengths(texts):
    """Lengths by another library and the same vocabulary."""
    t = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return [len(t.encode(x, add_special_tokens=False).ids) if x else 0 for x in texts]


def test_lengths_and_suffix_sums(spark):
    rows = awkward()
    n = plain_lengths([t for _, t, *_ in rows])
    hist = th.length_histogram(th.token_lengths(documents(spark, rows))).cache()
    got = {r["n_tokens"]: r for r in hist.collect()}
    assert {k: r["n_docs"] for k, r in got.items()} == Counter(n)
    for k, r in got.items():
        assert r["docs_at_least"] == sum(x >= k for x in n)
        assert r["tokens_at_least"] == sum(x for x in n if x >= k)
        assert r["truncated_total"] == sum(min(x, k) for x in n)
        assert abs(r["share_up_to"] - sum(x <= k for x in n) / len(n)) < 1e-12
    limits = [1, 7, 60, 1024, 10**6]
    assert {r["context"]: r["total"] for r in th.truncated_totals(hist, limits).collect()} == {c: sum(min(x, c) for x in n) for c in limits}
    shares = [0.1, 0.5, 0.9, 1.0]
    ordered = sorted(n)
    want = {s: next(x for x in ordered if sum(y <= x for y in n) / len(n) >= s) for s in shares}
    assert {r["share"]: r["n_tokens"] for r in th.quantiles(hist, shares).collect()} == want


def test_empty_table_and_special_words(spark):
    assert th.length_histogram(th.token_lengths(documents(spark, []))).count() == 0
    texts = ["<|endoftext|>", "it's  \n\n spaced   out 123456", "naïve façade 日本語 🙂"]
    got = th.token_lengths(documents(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in got] == plain_lengths(texts)


def test_query_on_the_small_table(spark):
    from eventmart.llm.queries import op3_token_histogram

    sf = "/root/testdata/sf0.001"
    n = plain_lengths([r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])
    assert {r["n_tokens"]: r["n_docs"] for r in op3_token_histogram(spark, sf).collect()} == Counter(n)
