"""Plain restatements of what the operators must return, for small tables."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

LOWER = {c: c + 32 for c in range(65, 91)}
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text, pattern=SPACED):
    return pattern.findall((text or "").translate(LOWER))


def near(rows, shingle=4):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))} if w else set()
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def exact(rows):
    """Ids that stay: the smallest of each group of equal texts."""
    first = {}
    for i, t in sorted(rows):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), i)
    return set(first.values())


def mixed(rows, weights=(5, 2, 1), share=1.5, most=2):
    """Words taken of each id; rows (id, text, source)."""
    size = {i: len(SPACED.findall(t or "")) for i, t, _ in rows}
    of = collections.defaultdict(list)
    for i, t, s in rows:
        of[s].append((hashlib.sha256(f"mix:{i}:{hashlib.md5((t or '').encode()).hexdigest()}".encode()).hexdigest()[:16], size[i], i))
    sources = sorted(of, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sources)}
    words = {s: sum(n for _, n, _ in of[s]) for s in sources}
    target, open_ = {}, set(sources)
    while True:
        left = share * sum(words.values()) - sum(most * words[s] for s in sources if s not in open_)
        target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if target[s] > most * words[s]}
        if not full:
            break
        target |= {s: float(most * words[s]) for s in full}
        open_ -= full
    taken = {}
    for s in sources:
        budget = math.floor(round(target[s], 6) + 0.5)
        epochs = budget // words[s] if words[s] else 0
        rest = budget - epochs * words[s]
        for _, n, i in sorted(of[s]):
            part = max(0, min(n, rest))
            taken[i] = epochs * n + part
            rest -= part
    return taken


def leaks(docs, items):
    grams = collections.defaultdict(set)
    for i, t in items:
        w = words(t, ALNUM)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            grams[tuple(w[k : k + n])].add(str(i))
    sizes = {len(g) for g in grams}
    out = {}
    for i, t in docs:
        w, hit, names = words(t, ALNUM), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if named := grams.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    names |= named
        out[i] = (len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit))
    return out


def luhn(match):
    digits = [int(c) for c in match if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0


def _digits(match):
    return sum(c in "0123456789" for c in match)


PERSONAL = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= _digits(m) <= 19 and luhn(m)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= _digits(m) <= 15),
]
SECRETS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
]


def personal(text):
    found = [[f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text or "") if f(m[0])] for k, p, f in PERSONAL]
    spans = [s for f in found for s in f]
    return [len(f) for f in found], spans, hashlib.sha256(",".join(spans).encode()).hexdigest()


def secrets(text):
    found = [[(m.start(), k, f"{n}:{m.start()}:{m.end()}") for m in re.finditer(p, text or "", re.A) if f(m)] for k, (n, p, f) in enumerate(SECRETS)]
    spans = [s[2] for s in sorted(s for f in found for s in f)]
    return [len(f) for f in found], spans, hashlib.sha256(",".join(spans).encode()).hexdigest()


def crc(i):
    return zlib.crc32(("" if i is None else str(i)).encode())


def base_scores(rows):
    count = collections.Counter()
    for i, t in rows:
        if crc(i) % 5 != 1:
            count.update([*words(t), None])
    total, distinct = sum(count.values()), len(count)
    out = []
    for _, t in rows:
        w = [*words(t), None]
        out.append((len(w), sum(count[x] > 0 for x in w), total, sum(math.log10((count[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in w)))
    return out


def kt(zeros, ones):
    return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(zeros + ones + 1)


def tree_scores(rows, depth):
    """Context-tree weighting by recursion over nodes held in dictionaries."""
    nodes = collections.defaultdict(lambda: [0, 0])
    children = collections.defaultdict(set)

    def steps(text):
        data = bytes([255] * depth) + (text or "").translate(LOWER).encode() + b"\xff"
        for k in range(depth, len(data)):
            for b in range(8):
                yield data[k - depth : k], (1 << b) | (data[k] >> (8 - b)), (data[k] >> (7 - b)) & 1

    for i, t in rows:
        if crc(i) % 5 != 1:
            for context, node, bit in steps(t):
                for d in range(depth + 1):
                    own = context[depth - d :]
                    nodes[own, node][bit] += 1
                    if d < depth:
                        children[own, node].add(context[depth - d - 1 :])
    memo = {}

    def weighted(context, node):
        if (context, node) not in memo:
            own = kt(*nodes[context, node])
            if len(context) < depth:
                below = sum(weighted(c, node) for c in children[context, node])
                top = max(own, below)
                own = top + math.log(0.5 * math.exp(own - top) + 0.5 * math.exp(below - top))
            memo[context, node] = own
        return memo[context, node]

    def probability(context, node, bit, d):
        own = nodes.get((context[depth - d :], node), (0, 0))
        value = (own[bit] + 0.5) / (sum(own) + 1)
        if d == depth or sum(nodes.get((context[depth - d - 1 :], node), (0, 0))) == 0:
            return value
        stop = math.exp(math.log(0.5) + kt(*own) - weighted(context[depth - d :], node))
        return stop * value + (1 - stop) * probability(context, node, bit, d + 1)

    return [sum(math.log10(probability(c, n, b, 0)) for c, n, b in steps(t)) for _, t in rows]
