"""Plain versions of whitening, mixing and conversation repair."""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from .brute import SPACE, sha


def whitened(rows, most=32):
    """{id: (deviation, whitened)}, n, values, shares by a whole decomposition."""
    good = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n = len(good)
    sums = [sum(c) for c in zip(*(x for _, x in good), strict=True)]
    off = [[n * c - s for c, s in zip(x, sums, strict=True)] for _, x in good]
    y = np.array([[c / n for c in o] for o in off])
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values)[:most]
    white = (y @ vectors[:, order]) / np.sqrt(values[order])
    return [(i, sum(c * c for c in o), w) for (i, _), o, w in zip(good, off, white, strict=True)], n, values[order] / values.sum()


def targets(sizes):
    """Target of each source: shares by weight, what is over is shared again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] > 3 * sizes[s]}
        if not over:
            target |= {s: share * weight[s] for s in free}
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]
        free -= over
    return target


def after_damage(rows):
    """The contract's damage of (conv, turn, role, text)."""
    out = []
    for conv, turn, role, text in rows:
        said = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = said(role), said(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def repaired(rows):
    """A conversation's result, by a search over (row, state) in the order of (cost, audit); rows: (turn, role, text) in order."""
    counts, faults, seen = Counter(), [], set()
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
        counts[fault] += 1
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len({*turns}) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    todo, done = [(0, "", 0, "", ())], set()  # cost, audit, row, initials since the last pair, turns
    while todo:
        cost, audit, k, state, out = heapq.heappop(todo)
        if k == len(rows) and state in ("", "done"):
            return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha("\n".join(f"{a}:{b}" for a, b in out))
        if (k, state) in done:
            continue
        done.add((k, state))

        def push(c, letter, at, role, text):
            initial = role[:1]
            then = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("done", "u"): "u", ("u", "a"): "done"}.get((state, initial))
            if then:
                heapq.heappush(todo, (cost + c, audit + letter, at, then, (*out, (role, text))))

        for role in ("user", "assistant"):
            push(5, "I", k, role, "")
        if k < len(rows):
            _, role, text = rows[k]
            heapq.heappush(todo, (cost + 2, audit + "D", k + 1, state, out))
            if faults[k] not in ("blank", "duplicate"):
                more = 5 if faults[k] else 0
                push(more, "K", k + 1, role, text)
                for r in ("user", "assistant"):
                    push(1 + more, "R", k + 1, r, text)
    raise AssertionError


def conversations(rows):
    own = defaultdict(list)
    for conv, *rest in after_damage(rows):
        own[conv].append(tuple(rest))
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted(own[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        out.append((conv, *repaired(mine)))
    return out


def words(text):
    return len(SPACE.findall(text or ""))
