"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import re

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, sources=None):
    """Rows of (doc_id, text), with the other columns of the table."""
    rows = [
        (i, t, "en", (sources or {}).get(i, "s"), len(t) if t is not None else None) for i, t in texts
    ]
    return spark.createDataFrame(rows, DOCUMENT)


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingles(text, size=5):
    w = words(text)
    if not w:
        return frozenset()
    if len(w) < size:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def jaccard_components(rows, percent=80):
    """doc_id to (size of its set, smallest doc_id of its component), all pairs compared."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            common, union = len(sets[a][1] & sets[b][1]), len(sets[a][1] | sets[b][1])
            if union and common * 100 >= percent * union:
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    smallest = {}
    for at, (i, _) in enumerate(sets):
        root = find(at)
        known = [x for x in (smallest.get(root), i) if x is not None]
        smallest[root] = min(known) if known else None
    return [(i, len(s), smallest[find(at)]) for at, (i, s) in enumerate(sets)]
