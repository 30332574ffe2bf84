"""Plain versions of what the operators compute."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma".split()


def prose(n: int, seed: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + pick.choice(["", "", "s", "ed", "ing"]) for _ in range(n))


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def words(text):
    return (text or "").encode().split()


def shingles(text) -> frozenset:
    w = words((text or "").encode().lower().decode())
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard_components(rows):
    """rows: (id, text) with distinct ids; id -> (size, least id reached)."""
    sets = {i: shingles(t) for i, t in rows}
    ids = [i for i in sets if sets[i]]
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[:k]
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    roots = components(links, sets)
    return {i: (len(sets[i]), roots[i]) for i in sets}


def holds(kind, match) -> bool:
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = 0
        for k, d in enumerate(map(int, reversed(digits))):
            d *= 1 + k % 2
            total += d - 9 if d > 9 else d
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def private_spans(text):
    return [
        (kind, m.start(), m.end()) for kind, p in PATTERNS.items() for m in re.finditer(p, text or "") if holds(kind, m[0])
    ]


def unigrams(rows):
    counts, learn = Counter(), {}
    for i, t in rows:
        learn[i] = zlib.crc32(str(i).encode()) % 5 != 1
        if learn[i]:
            counts.update(words(t.encode().lower().decode()))
            counts[None] += 1
    total, distinct = sum(counts.values()), len(counts)
    base = math.log10(total + 0.5 * (distinct + 1))
    out = {}
    for i, t in rows:
        w = [*words(t.encode().lower().decode()), None]
        out[i] = (not learn[i], len(w), sum(counts[x] > 0 for x in w), total, sum(math.log10(counts[x] + 0.5) - base for x in w))
    return out


def context_tree(learned: list[bytes], depth: int):
    """log10 probability of a byte string under a context tree that learned one bit at a time."""
    counts, children = defaultdict(lambda: [0, 0]), defaultdict(set)

    def bits(data: bytes):
        padded = b"\n" * depth + data
        for k in range(depth, len(padded)):
            context, node = bytes(reversed(padded[k - depth : k])), 1
            for shift in range(7, -1, -1):
                bit = padded[k] >> shift & 1
                yield context, node, bit
                node = 2 * node + bit

    for data in learned:
        for context, node, bit in bits(data):
            for d in range(depth + 1):
                counts[context[:d], node][bit] += 1
                if d:
                    children[context[: d - 1], node].add(context[:d])
    memory: dict = {}

    def weighted(context, node):
        if (context, node) not in memory:
            a, b = counts.get((context, node), (0, 0))
            alone = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
            if len(context) == depth:
                memory[context, node] = alone, 1.0
            else:
                split = sum(weighted(c, node)[0] for c in children.get((context, node), ()))
                most = max(alone, split)
                both = most + math.log(math.exp(alone - most) + math.exp(split - most))
                memory[context, node] = both - math.log(2), math.exp(alone - both)
        return memory[context, node]

    def score(data: bytes) -> float:
        total = 0.0
        for context, node, bit in bits(data):
            chance = None
            for d in range(depth, -1, -1):
                n = counts.get((context[:d], node), (0, 0))
                own, stop = (n[bit] + 0.5) / (sum(n) + 1), weighted(context[:d], node)[1]
                chance = own if chance is None else stop * own + (1 - stop) * chance
            total += math.log10(chance)
        return total

    return score


def water_filled(total, loads):
    """loads: (weight, most); repeated sharing of the excess until none is above."""
    shares, full = [0.0] * len(loads), [False] * len(loads)
    while True:
        rest = total - sum(m for (_, m), f in zip(loads, full) if f)
        weight = sum(w for (w, _), f in zip(loads, full) if not f)
        over = False
        for k, (w, m) in enumerate(loads):
            shares[k] = m if full[k] else rest * w / weight
            if not full[k] and shares[k] > m:
                full[k] = over = True
        if not over or all(full):
            return [m if f else s for s, (_, m), f in zip(shares, loads, full)]
