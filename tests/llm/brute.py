"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import html
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACE = r"[^\x20\x09-\x0D]+"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))


def fingerprint(text):
    w = re.findall(SPACE, lower(text))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, prints, radius=3):
    prints, parent = np.array(prints, np.uint64), list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= radius) + i + 1:
            parent[root(j)] = root(i)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [least.get(root(i)) for i in range(len(prints))]


def shingles(text, k):
    w = re.findall(SPACE, lower(text))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def similar(ids, texts, k=5, percent=80):
    """Smallest id of each text's component; a text without words is its own."""
    sets, parent = [shingles(t, k) for t in texts], list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for j in range(i):
            if s and 100 * len(s & sets[j]) >= percent * len(s | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [least.get(root(i)) if sets[i] else d for i, d in enumerate(ids)]


def bench_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def contamination(docs, items):
    windows = defaultdict(set)
    for i, t in items:
        w = bench_words(t)
        for x in ([tuple(w)] if 0 < len(w) < 10 else [tuple(w[k : k + 10]) for k in range(len(w) - 9)]):
            windows[x].add(str(i))
    out = []
    for d, t in docs:
        w, hit, found = bench_words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[x]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def measures(text):
    text = text or ""
    w = re.findall(SPACE, text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if count[x] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(SPACE, x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def repeats(docs, n=50):
    least, data = {}, [(i, (t or "").encode()) for i, t in docs]
    for i, b in data:
        for k in range(len(b) - n + 1):
            if i is not None:
                least[b[k : k + n]] = min(i, least.get(b[k : k + n], i))
    out = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - n + 1):
            if i is not None and least[b[k : k + n]] < i:
                gone[k : k + n] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return out


def context_trees(docs, depth):
    """doc_id, held out, tokens, known tokens, training tokens, base score, score."""
    data = [(i, lower(t).encode()) for i, t in docs]
    train = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 != 0
    counts, tokens, children = defaultdict(lambda: [0, 0]), Counter(), defaultdict(list)

    def events(b):
        s = b"\xff" * depth + b + b"\xff"
        for i in range(depth, len(s)):
            for k in range(8):
                yield s[i - depth : i][::-1], (1 << k) | (s[i] >> (8 - k)), s[i] >> (7 - k) & 1

    for i, b in data:
        if train(i):
            tokens.update([*b.split(), b""])
            for context, node, bit in events(b):
                for d in range(depth + 1):
                    counts[context[:d], node][bit] += 1
    for c, v in counts:
        if c:
            children[c[:-1], v].append((c, v))
    kt = lambda n: math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.lgamma(sum(n) + 1) - math.log(math.pi)
    weighted = {}
    for key in sorted(counts, key=lambda k: -len(k[0])):
        own = kt(counts[key])
        weighted[key] = own if len(key[0]) == depth else np.logaddexp(own, sum(weighted[k] for k in children[key])) - math.log(2)

    def one(context, node):
        p = None
        for d in range(depth, -1, -1):
            if (key := (context[:d], node)) in counts:
                n = counts[key]
                k = (n[1] + 0.5) / (sum(n) + 1)
                stop = math.exp(kt(n) - math.log(2) - weighted[key])
                p = k if p is None else stop * k + (1 - stop) * p
        return 0.5 if p is None else p

    total, kinds, out = sum(tokens.values()), len(tokens), []
    for i, b in data:
        score = sum(math.log10(p if bit else 1 - p) for c, v, bit in events(b) for p in [one(c, v)])
        words = [*b.split(), b""]
        base = sum(math.log10((tokens[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in words)
        out.append((i, not train(i), len(words), sum(tokens[w] > 0 for w in words), total, base, score))
    return out


def article(page):
    found = re.search(r"<article>(.*?)(</article>|<footer|$)", page, re.S)
    blocks = re.split(r"</?p>|</?h1>", found[1])
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*(>|$)", " ", b)).split()) for b in blocks]
    return "\n\n".join(b for b in blocks if b)
