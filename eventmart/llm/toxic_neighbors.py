"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine.

1. ``sample_examples``: at most ``EXAMPLES`` labelled rows per class (smallest
   digest of the id first); this is the only bounded sample, and its bound is a parameter.
2. ``learn_terms``: every word of the examples is a term. So is every beginning of
   words whose presence depends on the label beyond chance (G-squared of ``SIGNIFICANT``
   or more), so that inflected forms of one stem meet; a word counts for that beginning
   of it that tells most. A beginning counts once more, as dense, in a text where one word in
   ``DENSE`` or more has it: clean texts hold a stem now and then by chance.
3. ``vectors``: the counts of these terms in every whole text, staged; their
   document frequencies over all documents give the IDF. ``label_factor``: a term that
   depends on the label beyond chance weighs more, by its log odds ratio; all others
   keep their plain weight, none is left out.
4. ``BlockMaxIndex``: an inverted index of the examples, similar ones in one block.
   The short posting lists of rare words are added up; the long ones of the ``COMMON``
   most frequent words are cut into blocks, each with the largest weight of each word
   in it. Both bound what any example of a block can reach; blocks are visited from the highest
   bound down, for a number of texts at once, and a block whose bound is below a text's k-th
   best cosine so far is skipped for it. Who may be among the k nearest is scored in
   full: the neighbours are exact, all ties at the k-th place included.
5. Votes are weighted by distance and by how many labelled rows an example
   stands for (ties at the k-th place share what is left of the k votes). The votes
   that each example gets from the others, against its label, calibrate the score:
   a rising function fitted to them makes it a probability estimate. The
   nearest examples come with it as evidence.

Defined cases: null and empty texts, and texts without a term, get the
rate of labelled rows without evidence (0 when nothing was learned); null labels
are not learned from, a doc_id labelled twice counts as toxic if either label
is; of several texts under one labelled id the one of the smallest digest is the
example; repeated rows are scored each; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from eventmart.llm.common import stage

EXAMPLES = 10_000
NEIGHBORS = 15
#: examples of a block, words whose long lists are held by block, and texts that are searched for at once
BLOCK = 64
COMMON = 512
AT_ONCE = 64
#: shares of the blocks after which the k-th best cosine is looked up again
LOOK_UP = (0.03, 0.1, 0.2, 0.4)
#: G-squared from which a term's dependence on the label is no chance, and what a unit of log odds adds to its weight
SIGNIFICANT = 16.0
ODDS_WEIGHT = 1.0
#: letters of a word beginning, and the words of a text among which one of a stem makes it dense
BEGINNINGS = (3, 4, 5, 6, 7, 8)
DENSE = 128
#: weight of a neighbour at no distance is 1 / NEAREST
NEAREST = 0.1
#: weight of the rate without evidence among the votes
SHRINK = 2.0
#: cosines are rounded to this many digits; bounds are in single precision and allow for what that hides
DIGITS = 9
SLACK = 1e-4
#: bytes of text split into words at once (a longer text is split alone)
CHUNK_BYTES = 8 << 20
_KEPT_SCORES = 200_000


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.Table]:
    table = pa.Table.from_batches([batch])
    sizes = np.cumsum(pc.fill_null(pc.binary_length(table["text"]), 0).to_numpy())
    start = 0
    while start < len(sizes):
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + CHUNK_BYTES, "right")))
        yield table.slice(start, end - start)
        start = end


def words(texts: pa.ChunkedArray) -> tuple[pa.Array, pa.Array]:
    """(place of the text, word) of all words: lower-cased runs of letters."""
    text = pc.fill_null(texts, "").combine_chunks().cast(pa.string())
    lists = pc.split_pattern_regex(pc.utf8_lower(text), pattern=r"\PL+")
    place, word = pc.list_parent_indices(lists), pc.list_flatten(lists)
    some = pc.not_equal(word, "")
    return place.filter(some), word.filter(some)


def sample_examples(labels: DataFrame, limit: int = EXAMPLES, id_col: str = "doc_id",
                    label_col: str = "toxic") -> tuple[DataFrame, list[int]]:
    """(doc_id, toxic) of at most limit rows per class, and the class sizes over all labels."""
    rows = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("toxic"))
            .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    pick = [rows.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit) for k in (0, 1)]
    return stage(pick[0].unionByName(pick[1]), "toxic-examples")[0], [sizes.get(0, 0), sizes.get(1, 0)]


def _beginning(word: pa.Array, letters: int) -> pa.Array:
    """The first letters of each word, null for one that has no more than these."""
    return pc.if_else(pc.greater(pc.utf8_length(word), letters), pc.utf8_slice_codeunits(word, 0, letters), pa.scalar(None, pa.string()))


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(letters, term, toxic, n): in how many texts of a chunk a word (letters 0) or a beginning occurs, by label."""
    for batch in batches:
        for rows in _chunks(batch):
            place, word = words(rows["text"])
            coded = word.dictionary_encode()
            for letters in (0, *BEGINNINGS):
                form = (_beginning(coded.dictionary, letters) if letters else coded.dictionary).dictionary_encode()
                seen = pa.table({"place": place, "term": form.indices.take(coded.indices)}).drop_null()
                seen = seen.group_by(["place", "term"], use_threads=False).aggregate([])
                counts = pa.table({"term": seen["term"], "toxic": rows["toxic"].take(seen["place"])})
                counts = counts.group_by(["term", "toxic"], use_threads=False).aggregate([([], "count_all")])
                if len(counts):
                    terms = form.dictionary.take(counts["term"].combine_chunks())
                    yield from pa.table({"letters": pa.array([letters] * len(counts), pa.int32()), "term": terms,
                                         "toxic": counts["toxic"].cast(pa.int32()), "n": counts["count_all"]}).to_batches()


class Vocabulary:
    """The words of the examples, the most frequent first; then the telling beginnings, those that tell
    most first; then these as dense."""

    def __init__(self, terms: pa.Array, stems: pa.Array):
        self.terms, self.stems = terms, stems

    def __len__(self) -> int:
        return len(self.terms) + 2 * len(self.stems)

    def count(self, texts: pa.ChunkedArray) -> tuple[pa.ListArray, pa.ListArray]:
        """The term numbers of each text in order, and their counts."""
        place, word = words(texts)
        coded, place = word.dictionary_encode(), place.to_numpy().astype(np.int64)
        which = coded.indices.to_numpy()
        number = pc.fill_null(pc.index_in(coded.dictionary, value_set=self.terms), -1).to_numpy()[which]
        stem = np.full(len(coded.dictionary), len(self.stems), np.int64)
        for letters in BEGINNINGS:
            found = pc.index_in(_beginning(coded.dictionary, letters), value_set=self.stems, skip_nulls=True)
            stem = np.minimum(stem, pc.fill_null(found, len(self.stems)).to_numpy())
        stem = stem[which]
        has = stem < len(self.stems)
        size = max(1, len(self))
        key = np.concatenate([(place * size + number)[number >= 0], (place * size + len(self.terms) + stem)[has]])
        key, n = np.unique(key, return_counts=True)
        text, term = np.divmod(key, size)
        dense = (term >= len(self.terms)) & (n * DENSE >= np.bincount(place, minlength=len(texts))[text])
        key, n = np.r_[key, key[dense] + len(self.stems)], np.r_[n, n[dense]]
        order = np.argsort(key, kind="stable")
        text, term = np.divmod(key[order], size)
        cut = pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32())
        return tuple(pa.ListArray.from_arrays(cut, pa.array(x, pa.int32())) for x in (term, n[order]))


def _g_squared(a, b, n1, n0, log, one_or_more):
    """How far presence in a toxic and b clean of n1 and n0 texts depends on the label, over columns or arrays."""
    total, row = n1 + n0, a + b
    cells = ((a, row, n1), (b, row, n0), (n1 - a, total - row, n1), (n0 - b, total - row, n0))
    return sum(seen * log(one_or_more(seen) * total / one_or_more(rows * column)) for seen, rows, column in cells) * 2


def learn_terms(examples: DataFrame) -> Vocabulary:
    """Every word of the examples and their telling beginnings; examples has text and toxic."""
    counts = (examples.select("text", F.col("toxic").cast("int").alias("toxic"))
              .mapInArrow(_term_rows, "letters int, term string, toxic int, n long").groupBy("letters", "term")
              .agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
                   F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b")))
    counts, _ = stage(counts, "toxic-terms")
    n = {r["toxic"]: r["count"] for r in examples.groupBy("toxic").count().collect()}
    n1, n0 = (F.lit(float(n.get(k, 0))) for k in (1, 0))
    # the words of at most 2 x limit texts
    terms = counts.filter("letters = 0").select("term", (F.col("a") + F.col("b")).alias("n")).toArrow()
    terms = terms.take(pc.sort_indices(terms, [("n", "descending"), ("term", "ascending")]))["term"]
    g2 = F.round(_g_squared(F.col("a").cast("double"), F.col("b").cast("double"), n1, n0, F.log, lambda x: F.greatest(x, F.lit(1.0))), 6)
    stems = counts.filter("letters > 0").withColumn("g2", g2).filter(F.col("g2") >= SIGNIFICANT).select("term", "letters", "g2").toArrow()
    stems = stems.take(pc.sort_indices(stems, [("g2", "descending"), ("letters", "descending"), ("term", "ascending")]))["term"]
    return Vocabulary(*(pa.concat_arrays(t.cast(pa.string()).chunks) if len(t) else pa.array([], pa.string()) for t in (terms, stems)))


def label_factor(terms: list[np.ndarray], toxic: np.ndarray, size: int) -> np.ndarray:
    """The factor by which the label weights each of size terms: 1 where it may be chance."""
    a, b = (np.bincount(np.concatenate([np.empty(0, int), *[t for t, y in zip(terms, toxic, strict=True) if y == k]]), minlength=size).astype(float)
            for k in (1, 0))
    n1, n0 = float((toxic == 1).sum()), float((toxic == 0).sum())

    g2 = _g_squared(a, b, n1, n0, np.log, lambda x: np.maximum(x, 1)) if n1 + n0 else np.zeros(size)
    odds = np.log((a + 0.5) * (n0 - b + 0.5) / ((b + 0.5) * (n1 - a + 0.5)))
    return np.where(np.round(g2, 6) >= SIGNIFICANT, 1 + ODDS_WEIGHT * np.abs(odds), 1.0)


def vectors(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, terms, counts) of every row: numbers of the terms in the whole text, in order."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _chunks(batch):
                yield pa.RecordBatch.from_arrays([rows["doc_id"].combine_chunks(), *shared.value.count(rows["text"])], ["doc_id", "terms", "counts"])
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, "doc_id long, terms array<int>, counts array<int>")


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of a column as arrays."""
    cuts = column.offsets.to_numpy()
    return np.split(column.flatten().to_numpy(), cuts[1:-1] - cuts[0]) if len(column) else []


def idf(vecs: DataFrame, terms: int) -> np.ndarray:
    """ln(1 + documents / documents with the term), over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per term and task."""
        seen = np.zeros(terms, np.int64)
        for batch in batches:
            seen += np.bincount(batch["terms"].flatten().to_numpy(), minlength=terms)
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(seen[found])], ["t", "n"])

    out, n = np.zeros(terms), vecs.count()
    counts = vecs.select("terms").mapInArrow(count, "t int, n long").groupBy("t").agg(F.sum("n").alias("n")).toArrow()
    out[counts["t"].to_numpy()] = np.log(1 + n / counts["n"].to_numpy())
    return out


def unit(terms: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """TF-IDF weights of a text's terms, scaled to length 1."""
    w = (1 + np.log(np.asarray(counts, float))) * weights[np.asarray(terms, int)]
    return w / math.sqrt(float(w @ w)) if len(w) and w.any() else w


class BlockMaxIndex:
    """Exact nearest examples by cosine."""

    def __init__(self, examples: Iterable[tuple[int, np.ndarray, np.ndarray]], weights: np.ndarray, block: int = BLOCK, common: int = COMMON):
        self.weights = weights
        # examples that share their most frequent words are neighbours: blocks of one language and subject
        ordered = sorted(examples, key=lambda e: (list(e[1][:32]), list(e[2][:32]), e[0]))
        self.ids = np.array([e[0] for e in ordered], np.int64)
        n = len(ordered)
        self.terms = np.concatenate([np.empty(0, np.int32), *[np.asarray(e[1], np.int32) for e in ordered]])
        self.values = np.concatenate([np.empty(0), *[unit(t, c, weights) for _, t, c in ordered]])
        sizes = np.array([len(e[1]) for e in ordered], np.int64)
        self.starts = np.cumsum(sizes) - sizes
        self.sizes = sizes
        at = np.repeat(np.arange(n, dtype=np.int32), sizes)
        often = np.argsort(-np.bincount(self.terms, minlength=len(weights)), kind="stable")[:common]
        self.column = np.full(len(weights), -1, np.int32)
        self.column[often] = np.arange(len(often))
        col = self.column[self.terms]
        # the long lists as a table of examples, and the largest weights in each block of it
        self.table = np.zeros((n, len(often)), np.float32)
        self.table[at[col >= 0], col[col >= 0]] = self.values[col >= 0]
        self.cuts = np.arange(0, n, block)
        self.most = np.maximum.reduceat(self.table, self.cuts) if n else self.table
        # the short lists
        rare = np.flatnonzero(col < 0)
        rare = rare[np.argsort(self.terms[rare], kind="stable")]
        # place and weight of a posting side by side, in one number
        self.postings = np.empty(len(rare), np.int64)
        self.postings.view(np.int32)[0::2], self.postings.view(np.float32)[1::2] = at[rare], self.values[rare]
        self.cut = np.searchsorted(self.terms[rare], np.arange(len(weights) + 1))
        self.dense = np.zeros(len(weights))      # a text's weights while it is scored in full
        #: (text, block) pairs that searches so far looked into, and all that there were
        self.visited = self.possible = 0

    def nearest(self, terms: np.ndarray, counts: np.ndarray, k: int = NEIGHBORS) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the k nearest examples and all that tie with the last, best first."""
        return self.nearest_of([(terms, counts)], k)[0]

    def nearest_of(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBORS) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of each of some texts; texts alike should come together."""
        out = []
        for start in range(0, len(texts), AT_ONCE):
            out += self._search([(np.asarray(t, int), np.asarray(c)) for t, c in texts[start:start + AT_ONCE]], k)
        return out

    def _search(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        n, m = len(self.ids), len(texts)
        if not n:
            return [(np.empty(0, int), np.empty(0)) for _ in texts]
        units = [unit(t, c, self.weights) for t, c in texts]
        common = np.zeros((m, self.table.shape[1]), np.float32)
        score = np.zeros((m, n), np.float32)
        for i, ((t, _), u) in enumerate(zip(texts, units, strict=True)):
            col = self.column[t]
            common[i, col[col >= 0]] = u[col >= 0]
            t, u = t[col < 0], u[col < 0]
            size = self.cut[t + 1] - self.cut[t]
            t, u, size = t[size > 0], u[size > 0], size[size > 0]
            if len(t):
                first = self.cut[t].tolist()
                found = np.concatenate([self.postings[a:b] for a, b in zip(first, (self.cut[t] + size).tolist(), strict=True)])
                value = found.view(np.float32)[1::2] * np.repeat(u.astype(np.float32), size)
                score[i] = np.bincount(found.view(np.int32)[0::2], value, n)
        # what a block can reach at most: its best sum of short lists, and the largest weights of the long ones
        bound = np.maximum.reduceat(score, self.cuts, axis=1) + common @ self.most.T + SLACK
        order = np.argsort(-bound.max(0), kind="stable")
        least = np.full(m, SLACK)               # no block without any common term is worth a look
        seen = np.zeros((m, len(order)), bool)
        known = np.full((m, n), -1.0, np.float32)
        best = np.full((m, k), -1.0, np.float32)
        stops = sorted({max(1, int(x * len(order))) for x in LOOK_UP} | {len(order)})
        for start, stop in zip([0, *stops], stops):
            columns = []
            for b in order[start:stop]:
                asks = np.flatnonzero(bound[:, b] > least)
                if len(asks):
                    if len(asks) > m * 3 // 4:      # then all, without a copy of those that do
                        asks = slice(None)
                    rows = slice(self.cuts[b], self.cuts[b + 1] if b + 1 < len(self.cuts) else n)
                    known[asks, rows] = score[asks, rows] + common[asks] @ self.table[rows].T
                    seen[asks, b] = True
                    columns.append(np.arange(rows.start, rows.stop))
            if columns:         # the k best so far, from those and the new ones
                best = np.partition(np.concatenate([best, known[:, np.concatenate(columns)]], axis=1), -k, axis=1)[:, -k:]
                least = np.maximum(SLACK, best.min(1) - SLACK)
        self.visited += int(seen.sum())
        self.possible += seen.size
        floor = np.maximum(best.min(1) - SLACK, -0.5)      # what was not looked into stands at -1
        return [self._exact(t, u, np.flatnonzero(known[i] >= floor[i]), k)
                for i, ((t, _), u) in enumerate(zip(texts, units, strict=True))]

    def _exact(self, terms: np.ndarray, query: np.ndarray, place: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest among the examples at place, in double precision."""
        if not len(place) or not len(terms):
            return np.empty(0, int), np.empty(0)
        size, start = self.sizes[place], self.starts[place]
        own = [slice(a, b) for a, b in zip(start.tolist(), (start + size).tolist(), strict=True)]
        self.dense[terms] = query
        part = self.dense[np.concatenate([self.terms[x] for x in own])] * np.concatenate([self.values[x] for x in own])
        self.dense[terms] = 0.0
        # example by example, so that equal ones get equal cosines whatever else is scored
        cosine = np.round(np.add.reduceat(part, np.cumsum(size) - size), DIGITS)
        place, cosine = place[cosine > 0], cosine[cosine > 0]
        if len(place) > k:
            last = np.partition(cosine, len(place) - k)[len(place) - k]
            place, cosine = place[cosine >= last], cosine[cosine >= last]
        best = np.lexsort((self.ids[place], -cosine))
        return place[best], cosine[best]


class Learned:
    """What a task needs to rate texts; the index is built once in a worker."""

    def __init__(self, ids: np.ndarray, toxic: np.ndarray, vecs: pa.Table, weights: np.ndarray, stands: tuple[float, float], rate: float,
                 neighbors: int):
        self.ids, self.label, self.vecs, self.weights = ids, dict(zip(ids.tolist(), toxic.tolist(), strict=True)), vecs, weights
        self.stands, self.rate, self.neighbors = stands, rate, neighbors
        self._index: BlockMaxIndex | None = None

    @property
    def index(self) -> BlockMaxIndex:
        if self._index is None:
            lists = [[x for chunk in self.vecs[c].chunks for x in _lists(chunk)] for c in ("terms", "counts")]
            self._index = BlockMaxIndex([e for e in zip(self.ids.tolist(), *lists, strict=True) if len(e[1])], self.weights)
            self.toxic = np.array([self.label[i] for i in self._index.ids.tolist()], float)      # by position
            self.vecs = None
        return self._index

    def votes(self, texts: list[tuple[np.ndarray, np.ndarray]], leave_out: list[int] | None = None) -> list[tuple[float, str]]:
        """Of each text the share of toxic votes among its nearest examples, and the first of them as id:label:cosine."""
        alike = sorted(range(len(texts)), key=lambda i: texts[i][0][:32].tolist())
        found = self.index.nearest_of([texts[i] for i in alike], self.neighbors + (leave_out is not None))
        out: list = [None] * len(texts)
        for i, (place, cosine) in zip(alike, found, strict=True):
            if leave_out is not None:
                others = self.index.ids[place] != leave_out[i]
                place, cosine = place[others], cosine[others]
            out[i] = self._vote(place, cosine)
        return out

    def _vote(self, place: np.ndarray, cosine: np.ndarray) -> tuple[float, str]:
        k, ids, label = self.neighbors, self.index.ids[place], self.toxic[place]
        vote = np.where(label == 1, self.stands[1], self.stands[0]) / (NEAREST + 1 - np.minimum(cosine, 1))
        if len(ids) > k:  # the last ones tie for what is left of the votes
            last = cosine == cosine[-1]
            vote[last] *= (k - (~last).sum()) / last.sum()
        share = float((vote @ label + SHRINK * self.rate) / (vote.sum() + SHRINK))
        return share, ",".join(f"{i}:{t:.0f}:{c:.4f}" for i, t, c in zip(ids[:5].tolist(), label[:5].tolist(), cosine[:5].tolist(), strict=True))


class Calibration:
    """From vote shares to the share of toxic rows among those with such votes.

    Rows are pooled until the shares rise with the votes (isotonic regression), one
    row of no votes and one of all votes standing for what was never seen; in between
    two pools the share is interpolated.
    """

    def __init__(self, votes: np.ndarray, toxic: np.ndarray, weight: np.ndarray):
        votes, toxic, weight = np.r_[votes, 0.0, 1.0], np.r_[toxic, 0.0, 1.0], np.r_[weight, 1.0, 1.0]
        order = np.argsort(votes, kind="stable")
        pools: list[list[float]] = []      # sums of weighted votes, of toxic weight, of weight
        last = None
        for v, t, w in zip(votes[order].tolist(), toxic[order].tolist(), weight[order].tolist(), strict=True):
            pools.append([v * w, t * w, w])
            while len(pools) > 1 and (last == v or pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]):
                pool = pools.pop()
                pools[-1] = [x + y for x, y in zip(pools[-1], pool, strict=True)]
                last = None
            last = v
        self.votes = np.array([v / w for v, _, w in pools])
        self.shares = np.array([t / w for _, t, w in pools])

    def __call__(self, votes: np.ndarray) -> np.ndarray:
        return np.interp(votes, self.votes, self.shares)


def score(docs: DataFrame, labels: DataFrame, limit: int = EXAMPLES, neighbors: int = NEIGHBORS, threshold: float = 0.7,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(doc_id, score, predicted, evidence) of every row of docs; evidence lists nearest examples id:label:cosine."""
    spark = docs.sparkSession
    examples, (n0, n1) = sample_examples(labels, limit, id_col, label_col)
    # the examples are at most 2 x limit rows of two numbers
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    vocabulary = learn_terms(rows.join(F.broadcast(examples), "doc_id"))
    vecs, _ = stage(vectors(docs, vocabulary, id_col, text_col), "toxic-vectors")
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64("terms", "counts"), F.size("terms"))
    texts = vecs.join(F.broadcast(examples), "doc_id").withColumn("n", F.row_number().over(one)).filter("n = 1").drop("n")
    texts, _ = stage(texts, "toxic-texts")       # at most 2 x limit rows
    found = texts.toArrow()
    weights = idf(vecs, len(vocabulary)) * label_factor(
        [x for chunk in found["terms"].chunks for x in _lists(chunk)], found["toxic"].to_numpy(), len(vocabulary))
    toxic, blank = found["toxic"].to_numpy(), pc.list_value_length(found["terms"]).to_numpy() == 0
    drawn = [max(1, int((toxic == k).sum())) for k in (0, 1)]
    stands = (n0 / drawn[0], n1 / drawn[1])  # labelled rows that an example of the class stands for
    rate = n1 / (n0 + n1) if n0 + n1 else 0.0
    wordless = [stands[k] * float((blank & (toxic == k)).sum()) for k in (0, 1)]
    rate_blank = (wordless[1] + SHRINK * rate) / (sum(wordless) + SHRINK)
    shared = spark.sparkContext.broadcast(
        Learned(found["doc_id"].to_numpy(), toxic, found.select(["terms", "counts"]), weights, stands, rate, neighbors))

    def votes_of_examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, terms, counts = batch["doc_id"].to_numpy(), _lists(batch["terms"]), _lists(batch["counts"])
            some = [i for i, t in enumerate(terms) if len(t)]
            votes = shared.value.votes([(terms[i], counts[i]) for i in some], [int(ids[i]) for i in some])
            yield pa.RecordBatch.from_arrays(
                [pa.array([v for v, _ in votes], pa.float64()), batch["toxic"].cast(pa.int32()).take(pa.array(some, pa.int64()))], ["vote", "toxic"])

    # spread over the cluster by id: each example searches the index once
    judged = texts.repartition("doc_id").mapInArrow(votes_of_examples, "vote double, toxic int").toArrow()
    label = judged["toxic"].to_numpy().astype(float) if len(judged) else np.empty(0)
    calibrate = Calibration(judged["vote"].to_numpy() if len(judged) else label, label, np.where(label == 1, stands[1], stands[0]))

    def rate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[bytes, tuple[float, str]] = {}
        for batch in batches:
            if len(made) >= _KEPT_SCORES:
                made.clear()
            texts = list(zip(_lists(batch["terms"]), _lists(batch["counts"]), strict=True))
            keys = [hashlib.blake2b(t.tobytes() + b"/" + n.tobytes(), digest_size=16).digest() if len(t) else b"" for t, n in texts]
            new = {key: text for key, text in zip(keys, texts, strict=True) if key and key not in made}
            made.update(zip(new, shared.value.votes(list(new.values())), strict=True))
            out = [made[key] if key else (math.nan, "") for key in keys]
            votes = np.array([o[0] for o in out])
            scores = np.where(np.isnan(votes), rate_blank, calibrate(np.nan_to_num(votes)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64()), pa.array([o[1] for o in out], pa.string())],
                                             ["doc_id", "score", "evidence"])

    scored = vecs.mapInArrow(rate_batches, "doc_id long, score double, evidence string")
    return scored.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")
