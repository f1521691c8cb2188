"""HyperMinHash near duplicates against all pairs of sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tilth.llm import hyperminhash as H
from tilth.llm import similar

SCHEMA = "doc_id long, text string, n int, digest string, sketch string, node long, a int"


def shingles(text):
    w = re.findall(brute.SPACE, brute.lower(text))
    return frozenset(" ".join(w[i : i + 2]) for i in range(max(1, len(w) - 1))) if w else frozenset()


def plain(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for j in range(i):
            if s and 100 * len(s & sets[j]) >= 80 * len(s | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        own = least.get(root(i)) if sets[i] else d
        out.append((d, len(sets[i]), own, d == own))
    return sorted(out, key=repr)


def found(spark, rows):
    table = spark.createDataFrame([(*r, 1, "clash", "clash", 5, 2) for r in rows], SCHEMA).repartition(5)
    return sorted(map(tuple, H.digests(table).collect()), key=repr)


def changed(rng, words, k):
    out = list(words)
    for _ in range(k):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**9)}"
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(300)]
    texts = []
    for length in (1, 2, 5, 6, 7, 11, 12, 20, 40, 100, 300, 900):
        for _ in range(4):
            base = [rng.choice(vocabulary) for _ in range(length)]
            # Similarities around 0.8, and chains whose ends are far apart.
            texts += [changed(rng, base, rng.randrange(1 + length // 15)) for _ in range(5)]
            chain = base
            for _ in range(4):
                chain = changed(rng, chain, max(1, length // 22))
                texts.append(chain)
    made = [(i, rng.choice([" ", "\n", "  "]).join(w)) for i, w in enumerate(texts)]
    rng.shuffle(made)
    made += [(None, None), (None, "x y"), (3, None), (4, ""), (900, " \n\t"), (901, "X  y"), (902, "x"), (903, "X"), (904, "x x"), (905, "x x x"), (906, "日本 é"), (907, "日本\té")]
    made += made[:5] + [(None, made[0][1]), (None, "only null"), (None, "only  null"), (950, "word " * 90_000), (951, "word " * 80_000)]
    return made


def test_components(spark, rows):
    assert found(spark, rows) == plain(rows)


def test_crowded_buckets_in_several_runs(spark, monkeypatch):
    """Copies of one text with a few changes each, some linked with others but not with the smallest."""
    monkeypatch.setattr(similar, "RUN", 20)
    monkeypatch.setattr(similar, "BLOCK_MEMBERS", 60)
    rng = random.Random(9)
    base = [f"b{rng.randrange(500)}" for _ in range(120)]
    rows = [(i, " ".join(changed(rng, base, rng.randrange(9)))) for i in range(400)]
    assert found(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_recall_of_bands_and_estimate_at_the_bound():
    """Pairs of sets at 0.8 and more share a band and pass the estimate; their similarity is told within its deviation."""
    rng = np.random.default_rng(3)
    missed, errors = 0, []
    for trial in range(1500):
        n = int(rng.choice([5, 9, 20, 60, 250, 1000, 4000]))
        common = -(-4 * n // 5)
        members = rng.integers(0, 2**64, 2 * n, dtype=np.uint64)
        a, b = np.unique(members[:n]), np.unique(np.concatenate([members[:common]]))
        if trial % 2:
            grown = (n - common) // 2
            a, b = np.unique(members[: n - grown]), np.unique(np.concatenate([members[:common], members[n : n + grown]]))
        similarity = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        x, y = H.sketch(a), H.sketch(b)
        bands = (x == y)[: H.ROWS * H.BANDS].reshape(H.BANDS, H.ROWS).all(axis=1)
        near = H.estimate(x[None], y[None], np.array([len(a)]), np.array([len(b)]))[0]
        errors.append(near - similarity)
        least = 0.8 - H.SIGMAS * np.sqrt(0.16 / H.BUCKETS)
        missed += similarity >= 0.8 and not (bands.any() and near >= least)
    assert missed == 0 and abs(np.mean(errors)) < 0.005 and np.std(errors) < 0.03


def test_sets_of_a_column():
    texts = ["A b a B", None, "", "x", "\x0b\x0c", "a\x1cb c", "one"]
    got = [len(x) for x in similar.sets_of(pa.array(texts), H.SHINGLE)]
    assert got == [len(shingles(t)) for t in texts]
