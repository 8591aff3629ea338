"""Plain Python versions of the operators' contracts, for small inputs."""
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components(ids, linked):
    """Smallest reachable id of each; ``linked(i, j)`` for ids."""
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(ids)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if root(a) != root(b) and linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def near_duplicates(docs, percent):
    """docs: (doc_id, text) with ids all different -> doc_id: (n_shingles, component)."""
    sets = {i: shingles(t) for i, t in docs}
    comp = components(sets, lambda a, b: bool(sets[a] and sets[b]) and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]))
    return {i: (len(sets[i]), comp[i]) for i in sets}


def near_duplicate_rows(rows, percent):
    """rows: (doc_id, text), ids null or repeated -> one (doc_id, n_shingles, component, kept) each, and the rows' groups."""
    groups = near_duplicates(enumerate(t for _, t in rows), percent)
    least = {}
    for k, (_, g) in groups.items():
        if rows[k][0] is not None:
            least[g] = min(least.get(g, rows[k][0]), rows[k][0])
    out = [(rows[k][0], n, least.get(g), rows[k][0] == least.get(g) if rows[k][0] is not None else g not in least) for k, (n, g) in groups.items()]
    return out, [g for _, g in groups.values()]


def targets(sizes, share=1.5, limit=2.0, weights=(5, 2, 1)):
    """sizes: source -> words, by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    out, left, rest = {}, set(order), share * sum(sizes.values())
    while left:
        total = sum(weight[s] for s in left)
        over = [s for s in left if rest * weight[s] / total >= limit * sizes[s]]
        if not over:
            return out | {s: rest * weight[s] / total for s in left}
        for s in over:
            out[s] = limit * sizes[s]
            left.remove(s)
        rest = share * sum(sizes.values()) - sum(out.values())
    return out


def capacity(sizes, shards):
    """The smallest largest run, over all contiguous partitions, by dynamic programming."""
    best = [0, *[math.inf] * len(sizes)]
    total = np.concatenate([[0], np.cumsum(sizes)])
    for _ in range(shards):
        best = [min([best[j], *(max(best[i], total[j] - total[i]) for i in range(j))]) for j in range(len(sizes) + 1)]
    return best[-1]


_KINDS = (("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
          ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16))


def secrets(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p, g, least) in enumerate(_KINDS) for m in p.finditer(text or "") if len(m[g]) >= least]
    return sorted(found)


def span_text(spans):
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)


def bm25(docs, queries, k=10, k1=1.2, b=0.75, digits=6):
    """docs: (doc_id, text) rows -> query: [(doc_id, score)]."""
    bags = [(i, Counter(words(t))) for i, t in docs]
    n = len(bags)
    size = [sum(c.values()) for _, c in bags]
    mean = sum(size) / n if sum(size) else 1.0
    df = Counter(w for _, c in bags for w in c)
    out = {}
    for q, text in queries.items():
        scores = []
        for (i, c), s in zip(bags, size, strict=True):
            x = sum(math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * (k1 + 1) / (c[w] + k1 * (1 - b + b * s / mean)) for w in set(words(text)) if w in c)
            if x > 0 and i != q:
                scores.append((-round(x, digits), i))
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def repeats(texts, length=200):
    """texts: bytes of every row -> (n_bytes, n_removed, n_spans, kept_sha256) of each."""
    count = Counter(t[p:p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if count[t[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        spans = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(t)))
        out.append((len(t), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return out


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def by(rows, key):
    out = defaultdict(list)
    for r in rows:
        out[r[key]].append(r)
    return out


def alignment(texts, a, b, bytes_a, bytes_b):
    """texts: (doc_id, text); a, b: text -> ids; bytes_a, bytes_b: id -> bytes -> doc_id: the columns of op13."""
    found, linked = {}, Counter()
    for i, text in texts:
        raw = (" " + (text or "")).encode()
        ids_a, ids_b = (a(" " + text), b(text)) if text else ([], [])
        if not text or b"".join(map(bytes_a, ids_a)) != raw or b"".join(map(bytes_b, ids_b)) != raw:
            ids_a, ids_b = [], []
        ends_a = dict(zip(np.cumsum([len(bytes_a(x)) for x in ids_a]).tolist(), range(1, len(ids_a) + 1), strict=True))
        ends_b = dict(zip(np.cumsum([len(bytes_b(x)) for x in ids_b]).tolist(), range(1, len(ids_b) + 1), strict=True))
        cuts = [(0, 0), *((ends_a[e], ends_b[e]) for e in sorted(set(ends_a) & set(ends_b)))]
        groups = [(ids_a[p:r], ids_b[q:s]) for (p, q), (r, s) in zip(cuts, cuts[1:], strict=False)]
        links = [(x[-1], y[-1]) for x, y in groups]
        linked.update(links)
        found[i] = len(ids_a), len(ids_b), groups, links
    best = defaultdict(int)
    for (_, y), n in linked.items():
        best[y] = max(best[y], n)
    out = {}
    for i, (n_a, n_b, groups, links) in found.items():
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out[i] = (n_a, n_b, len(groups), len(links), sum(linked[p] == best[p[1]] for p in links), sum(linked[p] for p in links),
                  hashlib.sha256(line.encode()).hexdigest() if groups else "")
    return out, linked


def codes(rows, parts=16, entries=64, rounds=2):
    """rows: (vec_id, components, label), all usable -> one row (vec_id, code, error, label_error, digest) each."""
    ints = [[math.floor(256 * x) for x in v] for _, v, _ in rows]
    d = len(ints[0]) // parts
    cut = [[tuple(v[p * d:(p + 1) * d]) for p in range(parts)] for v in ints]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, ints[i]))[:entries]
    books = [[cut[i][p] for i in first] for p in range(parts)]

    def far(x, e):
        return sum((a - b) ** 2 for a, b in zip(x, e, strict=True))

    def nearest(v):
        return [min(range(len(books[p])), key=lambda k: (far(v[p], books[p][k]), k)) for p in range(parts)]

    for _ in range(rounds):
        own = [nearest(v) for v in cut]
        for p in range(parts):
            members = defaultdict(list)
            for v, code in zip(cut, own, strict=True):
                members[code[p]].append(v[p])
            for k, xs in members.items():
                books[p][k] = tuple(sum(c) // len(xs) for c in zip(*xs, strict=True))
    own = [nearest(v) for v in cut]
    error = [sum(far(v[p], books[p][c[p]]) for p in range(parts)) for v, c in zip(cut, own, strict=True)]
    per = Counter()
    for (_, _, label), e in zip(rows, error, strict=True):
        per[label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, bytes(c).hex(), e, per[label], digest) for (i, _, label), c, e in zip(rows, own, error, strict=True)]


def _prefix(values):
    out = [0.0]
    for v in values:
        out.append(out[-1] + v)
    return out


def _tree(grad, hess, leaves):
    """The value of each ordered bin: the cut that gains most first, until there are enough leaves."""
    g, h, cuts = _prefix(grad), _prefix(hess), [0, len(grad)]

    def gain(a, b):
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)

    for _ in range(leaves - 1):
        found = [(gain(a, k) + gain(k, b) - gain(a, b), -k) for a, b in zip(cuts, cuts[1:], strict=False) for k in range(a + 1, b)]
        if not found or max(found)[0] <= 1e-9:
            break
        cuts = sorted([*cuts, -max(found)[1]])
    return [(g[b] - g[a]) / (h[b] - h[a] + 1.0) for a, b in zip(cuts, cuts[1:], strict=False) for _ in range(b - a)]


def _cross(grad, hess, size):
    """The best two cuts of a joint histogram: gain and the value of each cell."""
    def total(t, rows, columns):
        return sum(t[i][j] for i in rows for j in columns)

    best = None
    for i in range(1, size):
        for j in range(1, size):
            parts = [(range(r0, r1), range(c0, c1)) for r0, r1 in ((0, i), (i, size)) for c0, c1 in ((0, j), (j, size))]
            sums = [(total(grad, *p), total(hess, *p)) for p in parts]
            gain = sum(a ** 2 / (b + 1.0) for a, b in sums)
            if best is None or gain > best[0] + 1e-12:
                best = gain, [(p, a / (b + 1.0)) for p, (a, b) in zip(parts, sums, strict=True)]
    out = [[0.0] * size for _ in range(size)]
    for (rows, columns), v in best[1]:
        for i in rows:
            for j in columns:
                out[i][j] = v
    whole = range(size), range(size)
    return best[0] - total(grad, *whole) ** 2 / (total(hess, *whole) + 1.0), out


def additive_model(bins, y, n_bins, rounds, leaves, rate, pair_bins, pair_rounds, n_pairs):
    """Cyclic boosting by plain loops over rows of bins -> the score of each row."""
    n, width = len(y), len(bins[0])
    base = sum(y) / n
    total = [math.log(base / (1 - base))] * n

    def slopes():
        p = [1 / (1 + math.exp(-t)) for t in total]
        return [a - b for a, b in zip(y, p, strict=True)], [b * (1 - b) for b in p]

    for _ in range(rounds):
        for f in range(width):
            grad, hess = [0.0] * n_bins, [0.0] * n_bins
            for row, g, h in zip(bins, *slopes(), strict=True):
                grad[row[f]] += g
                hess[row[f]] += h
            step = _tree(grad, hess, leaves)
            total = [t + rate * step[row[f]] for t, row in zip(total, bins, strict=True)]
    coarse = [[b * pair_bins // n_bins for b in row] for row in bins]

    def cross(f, g):
        grad, hess = ([[0.0] * pair_bins for _ in range(pair_bins)] for _ in range(2))
        for row, a, b in zip(coarse, *slopes(), strict=True):
            grad[row[f]][row[g]] += a
            hess[row[f]][row[g]] += b
        return _cross(grad, hess, pair_bins)

    chosen = sorted(((f, g) for f in range(width) for g in range(f)), key=lambda p: (-round(cross(*p)[0], 9), p))[:n_pairs]
    for _ in range(pair_rounds):
        for f, g in chosen:
            step = cross(f, g)[1]
            total = [t + rate * step[row[f]][row[g]] for t, row in zip(total, coarse, strict=True)]
    return [1 / (1 + math.exp(-t)) for t in total]
