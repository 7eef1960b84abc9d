"""Rows with the awkward cases every document operator must define."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, kid int, fp string, row string"


def documents(spark, rows):
    """rows: (doc_id, text[, lang, source]); some other columns clash with names the operators use."""
    full = [(*r, *[None] * (4 - len(r)))[:4] for r in rows]
    return spark.createDataFrame([(i, t, a, s, None if t is None else len(t), "x", 1, "y", None) for i, t, a, s in full], SCHEMA)


def awkward(seed: int = 0, n: int = 60):
    """Nulls, blanks, very long and repeated texts, ties, repeated rows, copies with other white space."""
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "delta", "été", "straße", "niño", "x", "42", "ﬀ", "𝒳"]
    rows = [(1, None), (2, ""), (3, " \t\r\n\x0b\x0c "), (4, "one"), (5, "one two"), (6, "ONE two"), (7, "one\ntwo"), (None, "no id"),
            (None, "no id"), (None, None), (8, "same row"), (8, "same row"), (9, "12345 678"), (10, " onetwo"), (11, "on e two")]
    for i in range(n):
        rows.append((100 + i, " ".join(rng.choices(words, k=rng.choice([1, 2, 3, 10, 60])))))
    base = [rng.choice(words) + str(rng.randrange(1000)) for _ in range(400)]
    for i in range(20):  # near copies, and exact ones in other spacing
        near = list(base)
        near[rng.randrange(400)] = f"changed{i}"
        rows += [(500 + i, " ".join(near)), (600 + i, "  ".join(base)), (700 + i, "\n".join(base))]
    rows.append((900, "long " * 30_000))
    return [(i, t, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", None])) for i, t in rows]


def groups(nodes, links):
    """node -> smallest node reachable."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
