"""Plain restatements of the operators for small inputs."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def repeats(docs, units, width):
    """For each (id, text): its units and which of them lie in a run that starts in a smaller id."""
    least = {}
    parts = [(i, units(t)) for i, t in docs]
    for i, seq in parts:
        for k in range(len(seq) - width + 1 if i is not None else 0):
            key = tuple(seq[k : k + width])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, seq in parts:
        gone = [False] * len(seq)
        for k in range(len(seq) - width + 1 if i is not None else 0):
            if least[tuple(seq[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        out.append((i, seq, gone))
    return out


def components(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingles(text, n):
    words = WORD.findall(lowered(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, 1)))


def near_links(docs, n, percent):
    """Linked pairs by full shingle sets, found through an inverted index."""
    sets = {i: shingles(t, n) for i, t in docs}
    by = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    links = set()
    for group in by.values():
        for a in group:
            for b in group:
                if a < b and (a, b) not in links:
                    both = len(sets[a] & sets[b])
                    if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                        links.add((a, b))
    return sets, links
