"""Plain versions of the operators, for small tables."""

import hashlib
import re
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def blank_words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(LOWER)) if w]


def letter_words(text):
    return [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER)) if w]


def shingles(text, k):
    w = blank_words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def near(docs, k, percent):
    """{id: (shingles, smallest id of the component)} from all pairs."""
    sets = {d: shingles(t, k) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), find(d)) for d in ids}


def contamination(docs, items, width=10):
    windows = defaultdict(set)
    for item, text in items:
        w = letter_words(text)
        for i in range(max(1, len(w) - width + 1)) if w else ():
            windows[tuple(w[i : i + width])].add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for d, text in docs:
        w, hit, held = letter_words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    held |= windows[key]
        out[d] = (len(w), len(hit), len(held), hashlib.sha256(",".join(sorted(held)).encode()).hexdigest(), bool(hit))
    return out


def repeats(docs, width=50):
    """{id: (words in repeated windows, those that no first occurrence covers)}"""
    seen = defaultdict(list)
    for d, text in sorted(docs):
        w = (text or "").encode().lower().split()
        for i in range(len(w) - width + 1):
            seen[tuple(w[i : i + width])].append((d, i))
    covered, first = defaultdict(set), defaultdict(set)
    for places in seen.values():
        if len(places) > 1:
            for k, (d, i) in enumerate(sorted(places)):
                covered[d].update(range(i, i + width))
                if k == 0:
                    first[d].update(range(i, i + width))
    return {d: (len(c), len(c - first[d])) for d, c in covered.items()}
