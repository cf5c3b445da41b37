"""Plain versions of the operators for small tables."""
from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np

BLANKS = " \t\n\x0b\x0c\r"


def components(n, links):
    top = list(range(n))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, j in links:
        a, b = sorted((find(i), find(j)))
        top[b] = a
    return [find(i) for i in range(n)]


def embedding_rows(rows, threshold=0.9):
    """(id, n_links, component, kept) of (id, vector) rows."""
    good = []
    for i, (_, v) in enumerate(rows):
        if v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v) or rows[i][0] is None:
            continue
        good.append(i)
    size = Counter(len(rows[i][1]) for i in good)
    dim = max(size, key=lambda d: (size[d], d)) if size else 0
    good = [i for i in good if len(rows[i][1]) == dim]
    x = {i: np.array(rows[i][1], float) / np.linalg.norm(np.array(rows[i][1], float)) for i in good}
    links = [(i, j) for k, i in enumerate(good) for j in good[k + 1:] if x[i] @ x[j] >= threshold]
    top = components(len(rows), links)
    count = Counter(e for link in links for e in link)
    smallest = {}
    for i, t in enumerate(top):
        if rows[i][0] is not None:
            smallest[t] = min(smallest.get(t, rows[i][0]), rows[i][0])
    out = []
    for i, (key, _) in enumerate(rows):
        root = smallest.get(top[i]) if key is not None else None
        out.append((key, count[i], root, key is None or key == root))
    return out


def topk(queries, vectors, k=5):
    out = []
    for q, a in queries:
        scored = sorted((-sum(x * y for x, y in zip(a, b)), v) for v, b in vectors if v != q and len(a) == len(b))
        out += [(q, r + 1, v, -s) for r, (s, v) in enumerate(scored[:k])]
    return out


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def dedup_lines(rows, min_chars=40, min_docs=5):
    """(id, n_lines, n_dropped, text) of (id, text) rows with distinct ids."""
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars and doc is not None:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(holders.get(key(x), ())) >= min_docs and max(holders[key(x)]) != doc)]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def words(text):
    return [key(w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]


def shingle_counts(text, n=5):
    w = words(text)
    if not w:
        return Counter()
    return Counter(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1)))


def near_classes(rows, threshold=0.8, n=5, cell=None, cells=None):
    """Class (smallest index) of each text; a shingle's document frequency is
    its cell's, if ``cell`` gives one, else its own."""
    counts = [shingle_counts(t, n) for t in rows]
    cell = cell or (lambda s: s)
    df = Counter(c for x in counts for c in {cell(s) for s in x})
    total = sum(1 for x in counts if x)
    weigh = [{s: c * (1 + math.log10((1 + total) / (1 + df[cell(s)]))) for s, c in x.items()} for x in counts]
    links = []
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            a, b = weigh[i], weigh[j]
            both = sum(min(a[s], b[s]) for s in a.keys() & b.keys())
            if both and both / (sum(a.values()) + sum(b.values()) - both) >= threshold:
                links.append((i, j))
    return components(len(rows), links)
