"""Alignment of two tokenizers over a corpus, with a fast path for tokens of equal bytes.

Each text, led by a space, is encoded whole by a byte-level vocabulary (A) and by a
piece vocabulary with byte fallback (B). Byte offsets where tokens of both end cut
the tokens into groups; every A and B occurrence of a group is linked. An id pair
counts the documents that hold it linked.

Identity map: ``identity[a]`` is the B id with the bytes of a. A group of one token
on each side whose B id is that one is regular: such pairs are counted in vectors as
long as A's vocabulary, and only the pairs of irregular groups are shuffled. Texts
are encoded once, in blocks of bounded size: a block stages, per document, its
distinct identity ids and its places in the block's own list of irregular pairs, and
once per block that list. Spark adds the pairs up over all blocks, hands each block
the counts of its own pairs, and the block sums them per document.

What reaches the driver and is broadcast: the vocabulary files and two vectors of
A's length, whatever the number of documents.

Defined cases: a null or empty text, or one whose joined token bytes are not the
space and the text (on either side), has no tokens: zeros and an empty digest; such
a row still gives its row. Repeated rows count each; null ids stay null; an empty
table gives an empty result; very long texts are a block of their own; other
columns are never looked at.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from eventmart.llm.common import drop_stage, stage
from eventmart.llm.token_histogram import PATTERN

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: characters of the texts in one block (a longer text is a block of its own)
BLOCK_CHARS = 1 << 22
#: links that are spelled out at once; a larger group is multiplied by its distinct ids
LINKS_AT_ONCE = 1 << 20

RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_decoder() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the rest for U+0100 onwards."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class Vocabularies:
    """Both encoders, the bytes of their tokens and the identity map."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import sentencepiece
        import tiktoken

        decode = byte_decoder()
        model = json.loads(a_file)["model"]
        ranks = {bytes(decode[c] for c in token): i for token, i in model["vocab"].items() if all(c in decode for c in token)}
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        ids = [model["vocab"][m] for m in merged]
        if ids != sorted(ids):
            raise ValueError("the A vocabulary's ids are not in the order of its merges")
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        self.n_a, self.n_b = max(ranks.values()) + 1, self.b.get_piece_size()
        self.a_bytes: list[bytes] = [b""] * self.n_a
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.n_b)]
        self.a_len = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_len = np.array([len(t) for t in self.b_bytes], np.int64)
        # a piece goes before a fallback byte of the same bytes
        by_bytes = {t: i for i, t in enumerate(self.b_bytes) if self.b.is_byte(i)}
        by_bytes.update({t: i for i, t in enumerate(self.b_bytes) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))})
        self.identity = np.array([by_bytes.get(t, -1) for t in self.a_bytes], np.int64)
        self.spelled = [f"{i}{end}" for i in range(self.n_a) for end in ",|"] + [f"{i}{end}" for i in range(self.n_b) for end in ",;"]

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """The ids of A and B; none if either does not spell the space and the text."""
        if not text:
            return [], []
        whole = f" {text}".encode()
        a, b = self.a.encode_ordinary(f" {text}"), self.b.encode(text, num_threads=1)
        if b"".join([self.a_bytes[i] for i in a]) != whole or b"".join([self.b_bytes[i] for i in b]) != whole:
            return [], []
        return a, b


@lru_cache(1)
def _vocabularies(a_file: bytes, b_file: bytes) -> Vocabularies:
    """Built once per worker process."""
    return Vocabularies(a_file, b_file)


def _distinct(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sum of n of each."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(n, at) if len(at) else n


class Block:
    """The groups and links of some documents, from their token ids."""

    def __init__(self, v: Vocabularies, encoded: list[tuple[list[int], list[int]]]):
        self.v, self.n_docs = v, len(encoded)
        self.n_a, self.n_b = (np.array([len(e[side]) for e in encoded], np.int64) for side in (0, 1))
        self.a, self.b = (np.fromiter(chain.from_iterable(e[side] for e in encoded), np.int64) for side in (0, 1))
        # the documents that have tokens lie one behind the other, as long on both sides
        a_end, b_end = np.cumsum(v.a_len[self.a]), np.cumsum(v.b_len[self.b])
        cuts = np.intersect1d(a_end, b_end, assume_unique=True)
        self.a_group, b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        self.in_a, self.in_b = np.bincount(self.a_group, minlength=len(cuts)), np.bincount(b_group, minlength=len(cuts))
        self.a_start, self.b_start = np.cumsum(self.in_a) - self.in_a, np.cumsum(self.in_b) - self.in_b
        self.doc = np.repeat(np.arange(self.n_docs), self.n_a)[self.a_start]  # of each group
        self.b_group = b_group

    def spellings(self) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` of each document."""
        v = self.v
        a_at, b_at = np.arange(len(self.a)), np.arange(len(self.b))
        order = np.empty(len(self.a) + len(self.b), np.int64)
        a_last = a_at == (self.a_start + self.in_a - 1)[self.a_group]
        b_last = b_at == (self.b_start + self.in_b - 1)[self.b_group]
        order[a_at + self.b_start[self.a_group]] = self.a * 2 + a_last
        order[b_at + (self.a_start + self.in_a)[self.b_group]] = 2 * v.n_a + self.b * 2 + b_last
        ends = np.cumsum(self.n_a + self.n_b)
        return ["".join([v.spelled[k] for k in order[end - n:end].tolist()])[:-1] for end, n in zip(ends, self.n_a + self.n_b, strict=True)]

    def _irregular(self, regular: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(document and pair as one key, links) of all groups that are not regular."""
        v = self.v
        groups = np.flatnonzero(~regular)
        links = self.in_a[groups] * self.in_b[groups]
        for g in groups[links > LINKS_AT_ONCE]:
            (a, m), (b, n) = (np.unique(ids[s:s + k], return_counts=True) for ids, s, k in
                              ((self.a, self.a_start[g], self.in_a[g]), (self.b, self.b_start[g], self.in_b[g])))
            for i, times in zip(a, m, strict=True):
                yield (self.doc[g] * v.n_a + i) * v.n_b + b, times * n
        groups, links = groups[links <= LINKS_AT_ONCE], links[links <= LINKS_AT_ONCE]
        part = (np.cumsum(links) - links) // LINKS_AT_ONCE
        for start, end in zip(*_runs(part), strict=True):
            g, n = groups[start:end], links[start:end]
            of = np.repeat(np.arange(len(g)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            a, b = self.a[self.a_start[g][of] + at // self.in_b[g][of]], self.b[self.b_start[g][of] + at % self.in_b[g][of]]
            yield _distinct((self.doc[g][of] * v.n_a + a) * v.n_b + b, np.ones(len(a), np.int64))

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys (document * n_a + a) of identity pairs and their links; keys ((document * n_a + a) * n_b + b) of the others and theirs."""
        v = self.v
        first_a, first_b = self.a[self.a_start], self.b[self.b_start]
        regular = (self.in_a == 1) & (self.in_b == 1) & (v.identity[first_a] == first_b)
        same = [(self.doc[regular] * v.n_a + first_a[regular], np.ones(int(regular.sum()), np.int64))]
        other = []
        for key, n in self._irregular(regular):
            doc_a, b = key // v.n_b, key % v.n_b
            alike = v.identity[doc_a % v.n_a] == b  # an identity pair inside a larger group
            same.append((doc_a[alike], n[alike]))
            other.append((key[~alike], n[~alike]))
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        return (*_distinct(*map(np.concatenate, zip(*same, strict=True))), *_distinct(*map(np.concatenate, zip(empty, *other, strict=True))))


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values."""
    if not len(sorted_values):
        return sorted_values, sorted_values
    starts = np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]])
    return starts, np.r_[starts[1:], len(sorted_values)]


_BLOCK_SCHEMA = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups_sha256", pa.string()), ("same", pa.binary()), ("same_n", pa.binary()), ("other", pa.binary()), ("other_n", pa.binary()),
    ("ids", pa.list_(pa.int32())), ("id_docs", pa.list_(pa.int64())), ("pairs", pa.list_(pa.int64())), ("pair_docs", pa.list_(pa.int64()))])
_BLOCK_SQL = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, same binary, same_n binary, "
              "other binary, other_n binary, ids array<int>, id_docs array<long>, pairs array<long>, pair_docs array<long>")


def _block_rows(v: Vocabularies, number: int, ids: list[int | None], texts: list[str | None]) -> pa.RecordBatch:
    """A row per document, and one more (without counts) that lists the block's ids and pairs with their documents."""
    block = Block(v, [v.encode(t) for t in texts])
    n = block.n_docs
    groups = np.bincount(block.doc, minlength=n)
    links = np.bincount(block.doc, block.in_a * block.in_b, n).astype(np.int64) if len(block.doc) else groups
    digests = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in block.spellings()]
    same, same_n, other, other_n = block.links()
    used, id_docs = np.unique(same % v.n_a, return_counts=True)
    pairs, places, pair_docs = np.unique(other % (v.n_a * v.n_b), return_inverse=True, return_counts=True)

    def by_doc(docs: np.ndarray, values: np.ndarray) -> list[bytes]:
        ends = np.searchsorted(docs, np.arange(n + 1))
        return [values[s:e].tobytes() for s, e in zip(ends[:-1], ends[1:], strict=True)]

    same_doc, other_doc = same // v.n_a, other // (v.n_a * v.n_b)
    none = [None] * n
    columns = [
        [number] * (n + 1), [*ids, None], [*block.n_a.tolist(), None], [*block.n_b.tolist(), None], [*groups.tolist(), None],
        [*links.tolist(), None], [*digests, None], [*by_doc(same_doc, (same % v.n_a).astype("<u4")), None],
        [*by_doc(same_doc, same_n.astype("<i8")), None], [*by_doc(other_doc, places.astype("<u4")), None],
        [*by_doc(other_doc, other_n.astype("<i8")), None],
        [*none, used], [*none, id_docs], [*none, pairs], [*none, pair_docs]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _BLOCK_SCHEMA, strict=True)], schema=_BLOCK_SCHEMA)


def _blocks(docs: DataFrame, vocabularies: Callable[[], Vocabularies]) -> DataFrame:
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            part = np.cumsum([len(t or "") for t in texts]) // BLOCK_CHARS
            for start, end in zip(*_runs(part), strict=True):
                yield _block_rows(vocabularies(), number, ids[start:end], texts[start:end])
                number += 1

    return docs.mapInArrow(blocks, _BLOCK_SQL)


def _vector(rows: pd.DataFrame, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    out[rows["a"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def align(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    n_best counts the links whose pair has the highest count of its A id, ties
    included; count_sum adds the pair counts of all links up.
    """
    spark = docs.sparkSession
    files = []
    for path in (a_file, b_file):  # small files beside the driver
        with open(path, "rb") as file:
            files.append(file.read())
    shared = spark.sparkContext.broadcast(files)
    sizes = _vocabularies(*files)
    n_a, n_b = sizes.n_a, sizes.n_b
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    blocks, _ = stage(_blocks(rows, lambda: _vocabularies(*shared.value)), "align-blocks")

    lists = blocks.filter("pairs is not null")
    ids = lists.select(F.explode(F.arrays_zip("ids", "id_docs")).alias("i")).groupBy(F.col("i.ids").alias("a")).agg(F.sum("i.id_docs").alias("n"))
    same = _vector(ids.toPandas(), n_a)  # at most n_a rows

    zipped = F.posexplode(F.arrays_zip("pairs", "pair_docs")).alias("place", "p")
    wanted = lists.select("block", zipped).select("block", "place", F.col("p.pairs").alias("pair"), F.col("p.pair_docs").alias("docs"))
    counts, counts_path = stage(wanted.groupBy("pair").agg(F.sum("docs").alias("n")), "align-pairs")
    best = counts.groupBy(F.expr(f"pair div {n_b}").alias("a")).agg(F.max("n").alias("n"))
    best = np.maximum(_vector(best.toPandas(), n_a), same)  # at most n_a rows
    known = spark.sparkContext.broadcast((same, best))

    found = wanted.select("block", "place", "pair").join(counts.withColumnRenamed("pair", "counted"), F.col("pair") == F.col("counted"))
    found, _ = stage(found.select("block", "place", "pair", "n"), "align-found")
    drop_stage(spark, counts_path)
    out_schema = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                            ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])

    def sums(values: pa.Table, counted: pa.Table) -> pa.Table:
        same_count, best_count = known.value
        same_best = same_count == best_count
        place = counted["place"].to_numpy()
        count = np.zeros(len(place), np.int64)
        count[place] = counted["n"].to_numpy()
        is_best = np.zeros(len(place), bool)
        is_best[place] = counted["n"].to_numpy() == best_count[counted["pair"].to_numpy() // n_b]
        n_best, count_sum = [], []
        for ids_, ids_n, places, places_n in zip(*(values[c].to_pylist() for c in ("same", "same_n", "other", "other_n")), strict=True):
            ids_, places = np.frombuffer(ids_, "<u4"), np.frombuffer(places, "<u4")
            ids_n, places_n = np.frombuffer(ids_n, "<i8"), np.frombuffer(places_n, "<i8")
            n_best.append(int(ids_n[same_best[ids_]].sum() + places_n[is_best[places]].sum()))
            count_sum.append(int((ids_n * same_count[ids_]).sum() + (places_n * count[places]).sum()))
        columns = {**{c: values[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")},
                   "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        return pa.table([columns[f.name] for f in out_schema], schema=out_schema)

    values = blocks.filter("pairs is null").select(
        "block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "same", "same_n", "other", "other_n")
    return values.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(sums, RESULT)
