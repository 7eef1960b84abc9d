"""Secret scan: fixed patterns plus a guess-cost test of credential-context values.

Three base kinds are found by pattern. Beyond them, any value that stands in a
credential context (``pwd: ...``, ``passphrase=...``, ``auth is ...``) is priced:
``guess_bits`` is the least number of bits an attacker needs who guesses the
value as a chain of dictionary words, dates, repeats, keyboard walks and
brute-force characters, found by dynamic programming over the whole value. A
value of ``min_bits`` or more that no base span covers adds a span of kind cost.

The dictionary is the fixed list of password words and up to ``DICTIONARY`` words that
most documents of the corpus hold (two at least), counted over all documents; a word's
price is its rank. Prose is not a secret: after ``is`` a value must have more than letters of a word.

Defined cases: null text counts as empty (no spans); texts and values are
scanned whole, whatever their length, in time that grows with it; repeated rows are
scanned (and counted for the dictionary) each; words of equally many documents rank
by their letters, and are all left out where they would exceed the dictionary's size;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Mapping
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from eventmart.llm.common import drop_stage, stage
from eventmart.llm.source_audit import term_counts

KINDS = ("assign", "access", "hex", "cost")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
# the maximal runs of the two plain kinds, with their least length in the pattern
ACCESS = re.compile("AKIA[A-Z0-9]{14,}")
HEX = re.compile("[0-9a-f]{16,}")
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code|key)?|pwd|secret|token|credentials?|auth|bearer|"""
    r"""(?:api|access|private|client|account|encryption|signing)[ _-]?(?:key|secret|token))"""
    r"""["']?\x20*(?:[:=]|=>|\x20(is)\x20)\x20*["']?([^\s"'<>,;]{6,})""", re.ASCII | re.IGNORECASE)
#: letters of one word, as prose has them: all small, all capital or a first capital, joined by hyphens or apostrophes
PROSE = re.compile(r"(?:[^\W\d_]+['’-]?)+")
#: words of the corpus in the dictionary, and the letters they may have
DICTIONARY = 50_000
SHORTEST, LONGEST = 3, 24
#: values of this cost or more (2**40 is about 10**12 guesses) are secrets
MIN_BITS = 40.0

# Common password words, most frequent first; the price of a word is its rank.
WORDS = """
password admin welcome letmein login master secret qwerty monkey dragon shadow sunshine princess football
baseball superman batman trustno access hello freedom whatever flower summer winter spring autumn
changeme default guest root test user demo example sample temp server system network computer internet
love angel baby money lucky happy tiger eagle falcon ninja hunter killer soccer hockey pepper ginger
cookie cheese chocolate orange purple silver golden diamond charlie michael jordan thomas daniel jessica
ashley nicole andrew joshua matthew robert george london paris berlin madrid london boston texas
monday tuesday wednesday thursday friday saturday sunday january february march april june july august
september october november december company office manager service support public private database
backup oracle mysql postgres linux windows google apple amazon github docker token key api client
your here none null empty true false placeholder redacted hidden value string insert replace
""".split()
# Rows of the common keyboard, unshifted and shifted.
KEYBOARD = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = ("~!@#$%^&*()_+", "QWERTYUIOP{}|", "ASDFGHJKL:\"", "ZXCVBNM<>?")
# Usual letter substitutions.
LEET = str.maketrans({"@": "a", "4": "a", "3": "e", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t"})
DATES = [re.compile(p, re.ASCII) for p in (
    r"(?:19|20)\d\d", r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])",
    r"(?:0?[1-9]|[12]\d|3[01])[-/.]?(?:0?[1-9]|1[0-2])[-/.]?(?:19|20)\d\d",
    r"(?:0[1-9]|[12]\d|3[01])(?:0[1-9]|1[0-2])\d\d")]
YEAR_BITS, DATE_BITS = math.log2(130), math.log2(130 * 365)
SEGMENT_BITS = 1.0       # what each further segment adds: which kind comes next
REPEAT_BITS = 0.5        # one more of the same character
WALK_BITS = 1.5          # one more step to a neighbouring key

_PLACE = {c: (x + 0.5 * y, y) for rows in (KEYBOARD, SHIFTED) for y, row in enumerate(rows) for x, c in enumerate(row)}


def _char_bits(c: str) -> float:
    return math.log2(10 if c.isdigit() else 26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 1000)


def _neighbours(a: str, b: str) -> bool:
    p, q = _PLACE.get(a), _PLACE.get(b)
    return bool(p and q and a != b and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1)


class Dictionary:
    """Words with their prices in bits; finds all that a value holds in one pass over it."""

    def __init__(self, words: Mapping[str, float]):
        self.bits = dict(words)
        self._words = ahocorasick.Automaton()
        for word, bits in self.bits.items():
            self._words.add_word(word, (len(word), bits))
        if self.bits:
            self._words.make_automaton()

    def word_bits(self, part: str) -> float | None:
        """Price of a dictionary word, with a bit for capitals and one for substituted letters."""
        low = _lower(part)
        found = [self.bits.get(low, math.inf), self.bits.get(low.translate(LEET), math.inf) + 1]
        return None if min(found) == math.inf else min(found) + (part != low)

    def inside(self, value: str) -> list[list[tuple[int, float]]]:
        """For each end of a word in value: (its length, its price)."""
        out: list[list[tuple[int, float]]] = [[] for _ in range(len(value) + 1)]
        if not self.bits:
            return out
        low = _lower(value)
        raised = [0, *accumulate(a != b for a, b in zip(value, low, strict=True))]
        swapped = low.translate(LEET)
        for text, more in ((low, 0.0), (swapped, 1.0)) if swapped != low else ((low, 0.0),):
            for last, (n, bits) in self._words.iter(text):
                out[last + 1].append((n, bits + more + (raised[last + 1] > raised[last + 1 - n])))
        return out


def _lower(text: str) -> str:
    """Lower case, character by character."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def ranked(words: list[str]) -> dict[str, float]:
    """Words in order -> price by rank; the first place of a word counts."""
    return {w: math.log2(i + 2) for i, w in reversed(list(enumerate(words)))}


FIXED = Dictionary(ranked(WORDS))


def learn_dictionary(docs: DataFrame, size: int = DICTIONARY, text_col: str = "text") -> dict[str, float]:
    """Prices of the fixed words and of at most ``size`` words that most documents hold.

    All documents are counted, in partial counts per task. The number of words per
    document count (a small table) says from which count on they fit into the
    dictionary; only those reach the driver.
    """
    counts = term_counts(docs.select(F.col(text_col).alias("text"), F.lit("").alias("lang"), F.lit("").alias("source")))
    counts = counts.filter((F.col("docs") >= 2) & F.length("term").between(SHORTEST, LONGEST)).select("term", "docs")
    counts, path = stage(counts, "secret-words")
    least, held = None, 0
    for n_docs, n_words in counts.groupBy("docs").count().orderBy(F.desc("docs")).toLocalIterator():
        held += n_words
        if held > size:
            break
        least = n_docs
    kept = [] if least is None else counts.filter(F.col("docs") >= least).collect()
    drop_stage(docs.sparkSession, path)
    prices = ranked([r["term"] for r in sorted(kept, key=lambda r: (-r["docs"], r["term"]))])
    for word, bits in FIXED.bits.items():
        prices[word] = min(bits, prices.get(word, math.inf))
    return prices


def guess_bits(value: str, dictionary: Dictionary = FIXED) -> float:
    """Least cost over all segmentations of value, in bits.

    best[i] prices the first i characters. Repeats and walks cost a constant per
    further character, so one running state each covers spans of every length.
    """
    best = [0.0]
    repeat = walk = math.inf
    dates: dict[int, list[tuple[int, float]]] = {}
    words = dictionary.inside(value)
    before = ""
    for i, c in enumerate(value):
        if c.isdigit():
            for k, rule in enumerate(DATES):
                if m := rule.match(value, i):
                    dates.setdefault(m.end(), []).append((i, YEAR_BITS if k == 0 else DATE_BITS))
        alone = best[i] + _char_bits(c)
        enter = alone + SEGMENT_BITS
        repeat = min(repeat + REPEAT_BITS if c == before else math.inf, enter)
        walk = min(walk + WALK_BITS if _neighbours(before, c) else math.inf, enter)
        cost = min(alone, repeat, walk)
        for n, bits in words[i + 1]:
            cost = min(cost, best[i + 1 - n] + SEGMENT_BITS + bits)
        for start, bits in dates.pop(i + 1, ()):
            cost = min(cost, best[start] + SEGMENT_BITS + bits)
        best.append(cost)
        before = c
    return best[-1]


def _is_prose(value: str) -> bool:
    if not PROSE.fullmatch(value):
        return False
    return all(w.islower() or w.isupper() or w[1:].islower() for w in re.split("['’-]", value) if w)


def find_spans(text: str | None, min_bits: float = MIN_BITS, dictionary: Dictionary = FIXED) -> tuple[list[tuple[int, int, int]], int]:
    """((start, kind number, end), ...) in order, and how many assign values are cheaper than min_bits."""
    text = text or ""
    spans, weak = [], 0
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= 12:
            spans.append((m.start(), 0, m.end()))
            weak += guess_bits(m[2], dictionary) < min_bits
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = sorted(spans)
    starts = [start for start, _, _ in base]
    reach = [0, *accumulate((end for _, _, end in base), max)]      # how far the first spans reach
    for m in CONTEXT.finditer(text):
        value = m[2].rstrip(".:!?)]}*#%&$=")
        start, end = m.start(2), m.start(2) + len(value)
        if len(value) < 6 or reach[bisect_left(starts, end)] > start or (m[1] and _is_prose(value)):
            continue
        if guess_bits(value, dictionary) >= min_bits:
            spans.append((start, 3, end))
    return sorted(spans), weak


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


@lru_cache(2)
def _dictionary(prices: tuple[tuple[str, float], ...]) -> Dictionary:
    """Built once per worker process."""
    return Dictionary(dict(prices))


def scan(docs: DataFrame, min_bits: float = MIN_BITS, id_col: str = "doc_id", text_col: str = "text",
         prices: Mapping[str, float] | None = None) -> DataFrame:
    """Spans of every document: counts per kind, the digest of the base spans, all spans.

    (doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_cost, n_weak);
    spans lists kind:start:end in code points, end exclusive, by start and kind.
    n_weak counts assign values that cost less than min_bits (placeholders). The
    dictionary is learned from the documents unless its prices are given.
    """
    prices = learn_dictionary(docs, text_col=text_col) if prices is None else prices
    shared = docs.sparkSession.sparkContext.broadcast(tuple(sorted(prices.items())))       # DICTIONARY words and the fixed ones

    @pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_cost long, n_weak long")
    def found(texts: pd.Series) -> pd.DataFrame:
        dictionary, out = _dictionary(shared.value), []
        for text in texts:
            spans, weak = find_spans(text, min_bits, dictionary)
            n = [sum(kind == k for _, kind, _ in spans) for k in range(4)]
            base = _joined([s for s in spans if s[1] < 3])
            out.append((*n[:3], hashlib.sha256(base.encode()).hexdigest(), _joined(spans), n[3], weak))
        return pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_cost", "n_weak"])

    return docs.select(F.col(id_col).alias("doc_id"), found(F.col(text_col)).alias("found")).select("doc_id", "found.*")
