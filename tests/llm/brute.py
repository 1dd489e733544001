"""Plain versions of the operators, for comparison."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
FOLDED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def crc(text):
    return None if text is None else zlib.crc32(text.encode())


def minimax(rows, shards):
    """The smallest greatest shard over the groups of equal texts in the order of their smallest id."""
    groups = defaultdict(lambda: [None, 0])
    for i, t in rows:
        g = groups[t]
        g[0] = i if g[0] is None else min(g[0], i)
        g[1] += len((t or "").encode()) + 1
    return capacity([s for _, s in sorted(groups.values())], shards)


def capacity(sizes, shards):
    def needed(most):
        n, room = 1, most
        for s in sizes:
            if s > room:
                n, room = n + 1, most
            room -= s
        return n

    low, high = max(sizes, default=0), sum(sizes)
    while low < high:
        m = (low + high) // 2
        low, high = (low, m) if needed(m) <= shards else (m + 1, high)
    return low


def folded(text):
    return FOLDED.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def contaminated(docs, items, window=10):
    wins = defaultdict(set)
    for i, t in items:
        w = folded(t)
        m = min(window, len(w))
        for a in range(len(w) - m + 1 if m else 0):
            wins[tuple(w[a : a + m])].add(str(i))
    lengths = {len(w) for w in wins}
    out = []
    for d, t in docs:
        w = folded(t)
        hit, own = set(), set()
        for m in lengths:
            for a in range(len(w) - m + 1):
                if x := wins.get(tuple(w[a : a + m])):
                    own |= x
                    hit |= {*range(a, a + m)}
        out.append((d, len(w), len(hit), len(own), sha(",".join(sorted(own))), bool(hit)))
    return out


def secrets(text):
    t = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return [f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found)]


def features(text):
    t = text or ""
    w = SPACE.findall(t)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if SPACE.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len({*lines}), len(covered)


def substring_dedup(rows, window=13):
    first = {}
    every = [(i, SPACE.findall(t or "")) for i, t in rows]
    for i, w in every:
        for a in range(len(w) - window + 1):
            k = tuple(w[a : a + window])
            first[k] = min(first.get(k, i), i)
    out = []
    for i, w in every:
        gone = {a + k for a in range(len(w) - window + 1) if first[tuple(w[a : a + window])] < i for k in range(window)}
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def shingles(text, size=5):
    w = folded(text)
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def near(rows, least=0.8):
    """For each row its links, and the smallest id of its class."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            same = rows[i][1] is not None and rows[i][1] == rows[j][1]
            if same or a and b and len(a & b) >= least * len(a | b):
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    classes = defaultdict(list)
    for i in range(len(rows)):
        classes[root(i)].append(rows[i][0])
    return [(rows[i][0], min(classes[root(i)]), links[i]) for i in range(len(rows))]


def line_templates(rows, least_fixed=4, min_docs=3, whole_docs=2):
    """(id, lines that stay) of (id, text): every choice of at most two free stretches of four, over plain tokens."""
    from itertools import combinations

    holders, of_line = defaultdict(set), {}
    for i, text in rows:
        for p, line in enumerate((text or "").split("\n")):
            tokens = SPACE.findall(line)
            masked = ["<*>" if re.search("[0-9]", t) else t for t in tokens]
            n = len(masked)
            if not n:
                continue
            keys = {("whole", *(masked if set(masked) != {"<*>"} else ["", *tokens]))}
            cuts = [n * j // 4 for j in range(5)]
            for free in [c for k in (1, 2) for c in combinations(range(4), k)]:
                shown = tuple(tuple(masked[cuts[j] : cuts[j + 1]]) if j not in free else None for j in range(4))
                fixed = sum(t != "<*>" for s in shown if s for t in s)
                if fixed >= least_fixed and fixed >= n // 2:
                    keys.add((n, shown))
            of_line[i, text, p] = keys
            for k in keys:
                holders[k].add(i)
    goes = lambda i, k: len(holders[k]) >= (whole_docs if k[0] == "whole" else min_docs) and i != min(holders[k])
    return [(i, text and "\n".join(x for p, x in enumerate(text.split("\n")) if not any(goes(i, k) for k in of_line.get((i, text, p), ())))) for i, text in rows]
