"""Plain Python versions of the operators, for small tables."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def windows_removed(docs, width):
    """{doc_id: removed word places} for documents in doc_id order."""
    seen, out = set(), {}
    for i, t in sorted(docs):
        w = words(t)
        gone = set()
        for k in range(len(w) - width + 1):
            g = tuple(w[k: k + width])
            if g in seen:
                gone.update(range(k, k + width))
            seen.add(g)
        out[i] = gone
    return out


def bytes_removed(docs, length):
    count = Counter()
    raw = {i: (t or "").encode() for i, t in docs}
    for b in raw.values():
        count.update(b[k: k + length] for k in range(len(b) - length + 1))
    out = {}
    for i, b in raw.items():
        gone = set()
        for k in range(len(b) - length + 1):
            if count[b[k: k + length]] > 1:
                gone.update(range(k, k + length))
        out[i] = gone
    return out


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans(
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(w[k: k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def groups(nodes, edges):
    """{node: least reachable node}."""
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def near_groups(docs, n, percent):
    sets = {i: shingles(t, n) for i, t in docs}
    ids = sorted(sets)
    edges = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: len(s) for i, s in sets.items()}, groups(ids, edges)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def lines_removed(docs, k, min_words, min_exact):
    first, places = {}, []
    for i, t in sorted(docs):
        for n, line in enumerate((t or "").split("\n")):
            w = tuple(words(line))
            if len(w) >= min_exact:
                places.append((i, n, w))
                first.setdefault(w, (i, n))
    long = [w for w in first if len(w) >= min_words]
    near = {max(a, b, key=first.get) for x, a in enumerate(long) for b in long[x + 1:]
            if abs(len(a) - len(b)) <= k and edits(a, b) <= k}
    out = defaultdict(list)
    for i, n, w in places:
        if first[w] != (i, n) or w in near:
            out[i].append(n)
    return out


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def contaminated(docs, items, width):
    """{doc_id: (hit places, items)}."""
    seen = defaultdict(set)
    for item, text in items:
        w = terms(text)
        n = min(width, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            seen[tuple(w[k: k + n])].add(item)
    out = {}
    for i, text in docs:
        w, hits, names = terms(text), set(), set()
        for g, owners in seen.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k: k + len(g)]) == g:
                    hits.update(range(k, k + len(g)))
                    names |= owners
        out[i] = (hits, names)
    return out
