from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventmart.llm import token_alignment as ta
from eventmart.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.cases import awkward, documents

HEAVY = ["<s> </s> <unk> <|endoftext|>", "▁ under", "a▁b", "tab\tand\n\nlines ", "   ", "\x00\x01", "ﬀ 𝒳 é ‍", "日本語テキスト漢字", "=" * 300,
         " " * 700 + "x", "aaaa" * 200, "é" * 50, "don't can't WE'LL", " 　 x", "🙂🙃" * 20, "0123456789" * 9]


@pytest.fixture(scope="module")
def plain_side():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(ta.A_FILE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=ta.B_FILE)
    decode = ta.byte_decoder()
    names = {i: t for t, i in a.get_vocab().items()}

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(text):
        if not text:
            return []
        pa_ = [(i, bytes(decode[c] for c in names[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
        pb = [(i, b_bytes(i)) for i in b.encode(text)]
        if any(b"".join(t for _, t in p) != (" " + text).encode() for p in (pa_, pb)):
            return []
        out, ia, ib, at_a, at_b, ga, gb = [], 0, 0, 0, 0, [], []
        while ia < len(pa_) or ib < len(pb):  # the side that is behind steps on
            if at_a <= at_b:
                ga.append(pa_[ia][0])
                at_a += len(pa_[ia][1])
                ia += 1
            else:
                gb.append(pb[ib][0])
                at_b += len(pb[ib][1])
                ib += 1
            if at_a == at_b:
                out.append((ga, gb))
                ga, gb = [], []
        return out

    return encode


def plain(rows, encode):
    groups = [encode(t) for _, t, *_ in rows]
    counts = Counter()
    for doc in groups:
        counts.update({(a, b) for ga, gb in doc for a in ga for b in gb})
    best = Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for (i, *_), doc in zip(rows, groups, strict=True):
        links = [(a, b) for ga, gb in doc for a in ga for b in gb]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in doc)
        out.append((i, sum(len(ga) for ga, _ in doc), sum(len(gb) for _, gb in doc), len(doc), len(links),
                    sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
                   for r in df.collect()), key=repr)


def test_alignment_by_hand(spark, plain_side, monkeypatch):
    rows = awkward(n=30) + [(2000 + i, t) for i, t in enumerate(HEAVY)] + [(3000, HEAVY[7]), (3000, HEAVY[7])]
    want = plain(rows, plain_side)
    docs = documents(spark, rows).withColumn("block", F.lit(4)).withColumn("n_a", F.lit("x"))
    assert found(ta.align(docs)) == want
    monkeypatch.setattr(ta, "BLOCK_CHARS", 500)  # workers see it only where a block is made, below
    v = ta._vocabularies(*[open(f, "rb").read() for f in (ta.A_FILE, ta.B_FILE)])
    encoded = [v.encode(t) for _, t, *_ in rows]
    whole = ta.Block(v, encoded).links()
    monkeypatch.setattr(ta, "LINKS_AT_ONCE", 3)  # large groups by distinct ids, and many parts
    small = ta.Block(v, encoded).links()
    for keys, n, keys2, n2 in ((whole[0], whole[1], small[0], small[1]), (whole[2], whole[3], small[2], small[3])):
        assert np.array_equal(keys, keys2) and np.array_equal(n, n2)


def test_blocks_and_rows_of_the_table(spark, plain_side):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert found(QUERIES["op12_tokenizer_alignment"](spark, SF_SMALL)) == plain(rows, plain_side)


def test_small_blocks_agree(spark, plain_side, monkeypatch):
    import pyarrow as pa

    v = ta._vocabularies(*[open(f, "rb").read() for f in (ta.A_FILE, ta.B_FILE)])
    texts = [t for _, t, *_ in awkward(n=10)] + HEAVY
    for part in (texts, texts[:1], []):
        rows = ta._block_rows(v, 7, list(range(len(part))), part)
        assert isinstance(rows, pa.RecordBatch) and rows.num_rows == len(part) + 1
        assert sum(rows["n_links"].to_pylist()[:-1]) == sum(len(ga) * len(gb) for t in part for ga, gb in plain_side(t))


def test_empty_table(spark):
    out = ta.align(documents(spark, []))
    assert out.count() == 0 and out.columns[0] == "doc_id"


def test_byte_encoder_is_the_published_one_on_every_character(plain_side):
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(ta.A_FILE)
    a.encode_special_tokens = True
    v = ta._vocabularies(*[open(f, "rb").read() for f in (ta.A_FILE, ta.B_FILE)])
    points = [i for i in range(0x30000) if not 0xD800 <= i < 0xE000]
    rng = random.Random(0)
    texts = [f"a{chr(i)}{chr(rng.choice(points))} {chr(i)}1" for i in points]
    for start in range(0, len(texts), 20_000):
        part = texts[start:start + 20_000]
        other = [e.ids for e in a.encode_batch(part, add_special_tokens=False)]
        bad = [t for t, ids in zip(part, other, strict=True) if v.a.encode_ordinary(t) != ids]
        assert not bad, (len(bad), [ascii(t) for t in bad[:5]])
