"""Plain brute-force versions of the operators, for small inputs."""

import os
import re
import sys
from collections import defaultdict

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]
SF_CHECK = "/root/testdata/sf0.01"
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]


def shingles(text, width=5):
    w = words(text)
    if not w:
        return frozenset()
    if len(w) < width:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def jaccard_groups(rows, percent=80):
    """rows: (id, text). [(id, n, component id, links with other sets)]"""
    sets = [shingles(t) for _, t in rows]
    distinct = sorted({s for s in sets if s}, key=len)
    by_shingle = defaultdict(set)
    for i, s in enumerate(distinct):
        for x in s:
            by_shingle[x].add(i)
    parent = list(range(len(distinct)))
    links = [0] * len(distinct)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(distinct):
        common = defaultdict(int)
        for x in s:
            for j in by_shingle[x]:
                if j < i:
                    common[j] += 1
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(distinct[j]) - c):
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    index = {s: i for i, s in enumerate(distinct)}
    least = {}
    for (doc, _), s in zip(rows, sets):
        if s and doc is not None:
            r = root(index[s])
            least[r] = min(least.get(r, doc), doc)
    return [
        (doc, len(s), least.get(root(index[s])) if s else doc, links[index[s]] if s else 0) for (doc, _), s in zip(rows, sets)
    ]
