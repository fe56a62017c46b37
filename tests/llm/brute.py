"""Plain Python versions of the operators, for small inputs."""

import hashlib
import math
import re
from collections import Counter, defaultdict


def line_dedup(rows, min_words=50, window=4):
    """rows: (doc_id, text). -> {(doc_id, text): (text left, lines, removed)}"""
    docs = {}
    for d, t in rows:
        if d is not None and t is not None:
            docs[str(d).rjust(20, "0") + hashlib.md5(t.encode()).hexdigest()[:8]] = (d, t)
    lines, prints = {}, defaultdict(list)
    for k in sorted(docs):
        kept = [(pos, x.strip(" "), len(re.findall(r"\S+", x, re.A))) for pos, x in enumerate(docs[k][1].split("\n"))]
        kept = [(pos, hashlib.md5(x.encode()).hexdigest()[:16], w) for pos, x, w in kept if w]
        lines[k] = kept
        grams = []
        for i in range(len(kept)):
            j, words = i, 0
            while j < len(kept) and words < min_words:
                words += kept[j][2]
                j += 1
            if words < min_words:
                break
            grams.append(hashlib.md5("".join(h for _, h, _ in kept[i:j]).encode()).hexdigest())
        picked = set()
        for i in range(len(grams)):
            span = range(i, min(i + window, len(grams)))
            picked.add(min(span, key=lambda n: (grams[n], -n)))
        for n in sorted(picked):
            prints[grams[n]].append((k, n))
    gone = defaultdict(set)
    matches = defaultdict(dict)
    for found in prints.values():
        for k, n in found[1:]:
            matches[k][n] = found[0]
    for k, mine in matches.items():
        places = sorted(mine)
        for i, n in enumerate(places):
            fk, fn = mine[n]
            low = places[i - 1] if i else -1
            high = places[i + 1] if i + 1 < len(places) else len(lines[k])
            for step, edge in ((1, high), (-1, low)):
                at = n if step == 1 else n - 1
                while at != edge and 0 <= at < len(lines[k]) and 0 <= fn + at - n < len(lines[fk]) and lines[fk][fn + at - n][1] == lines[k][at][1]:
                    gone[k].add(lines[k][at][0])
                    at += step
    out = {}
    for k, (d, t) in docs.items():
        parts = t.split("\n")
        out[d, t] = ("\n".join(x for i, x in enumerate(parts) if i not in gone[k]), len(parts), len(gone[k]))
    return out


def mixture(rows, entropy=0.95, repeats=4.0, block_tokens=200_000):
    """rows: (doc_id, source, text). -> Counter of (doc_id, source, tokens, weight to 9 digits, copies)"""
    size = lambda t: len(re.findall(r"\S+", t or "", re.A))
    by = Counter()
    for _, s, t in rows:
        by[s] += size(t)
    full = {s: n for s, n in by.items() if n}
    everything = sum(full.values())
    p = {s: n / everything for s, n in full.items()}

    def spread(a):
        z = sum(x**a for x in p.values())
        return z, -sum(x**a / z * math.log(x**a / z) for x in p.values())

    def largest(held):
        if held(1.0):
            return 1.0
        low, width = 0.0, 1.0
        for _ in range(30):
            width /= 2
            if held(low + width):
                low += width
        return low

    a = 0.0
    if len(p) > 1:
        a = largest(lambda a: spread(a)[1] >= (entropy - 1e-12) * math.log(len(p)))
    too_many = lambda a: min(p.values()) ** (a - 1) / spread(a)[0] > repeats
    if p and too_many(0.0):
        a = max(a, min(1.0, largest(too_many) + 0.5**30))
    z = spread(a)[0] if p else 1.0
    stretch = max((x ** (1 - a) for x in p.values()), default=0)
    out = Counter()
    for s in by:
        mine = [(d, t) for d, x, t in rows if x == s]
        if s not in full:
            out.update((d, s, 0, 0.0, 1) for d, _ in mine)
            continue
        w = p[s] ** a / z
        given = max(full[s], math.floor(w * everything * stretch * z + 1e-6))
        blocks = min(4096, -(-full[s] // block_tokens))
        keyed = sorted((int(h[:8], 16) % blocks, h, size(t), d) for d, t in mine for h in [hashlib.md5(f"mix{'' if d is None else d}".encode()).hexdigest()])
        rounds, room = divmod(given, full[s])
        used = 0
        for _, _, n, d in keyed:
            used += n
            out[d, s, n, round(w, 9), rounds + (used <= room)] += 1
    return out
