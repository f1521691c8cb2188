"""The trie of rebuilt conversations against a plain version."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tilth.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int"


def plain(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            turns[c].append((t is not None, t or 0, r, hashlib.md5(f"{len(r.encode())}:{r}{x}".encode()).digest(), x))
    for c in turns:
        turns[c].sort()
    paths = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        paths[c] = tuple((r, x) for _, _, r, _, x in turns.get(base, [])[:h] + turns[c][h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if paths[c] == p)
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows):
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(4)
    return sorted(map(tuple, trie.digests(table).collect()), key=repr)


@pytest.mark.parametrize("turns", [30, 200_000])
def test_small_tables_in_one_shard_and_in_many(spark, monkeypatch, turns):
    monkeypatch.setattr(trie, "SHARD_TURNS", turns)
    rng = random.Random(3)
    rows = []
    for c in range(-12, 90):
        for t in range(rng.randrange(1, 11)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["", None, "a", "é b", "long " * 9])))
    rows += rows[:40] + [(None, 0, "user", "nobody"), (3, None, "user", "first"), (4, None, None, None), (200, None, None, None), (200, None, None, None), (7, 1 << 40, "user", "late"), (8, -5, "user", "early")]
    rows += [(c, t, "user", f"copy {t}") for c in range(300, 420, 5) for t in range(12)]
    rows += [(c, 0, "user", "x" * 300_000) for c in (500, 505)]
    assert found(spark, rows) == plain(rows)


def test_conversations_longer_than_several_bands(spark, monkeypatch):
    monkeypatch.setattr(trie, "SHARD_TURNS", 500)
    rows = []
    # Copies that part at the ends of bands, next to them, and in deep bands; two end at a band's end.
    for k, (n, part) in enumerate([(800, 0), (800, 780), (300, 256), (300, 255), (300, 257), (512, 600), (256, 300)]):
        rows += [(5 * k, t, "user", f"{t}" if t < part or k == 0 else f"{t} of {k}") for t in range(n)]
    assert found(spark, rows) == plain(rows)


def test_only_turnless_conversations_and_none(spark):
    c = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    assert found(spark, [(c, 0, "user", "gone")]) == plain([(c, 0, "user", "gone")])
    assert found(spark, []) == []


def test_parentheses_of_random_trees():
    rng = np.random.default_rng(2)
    for n in (1, 2, 31, 64, 65, 500, 5000):
        for deep in (0.3, 0.5, 0.9):
            bits, open_, left = [], 0, n
            while left or open_:
                if left and (not open_ or rng.random() < deep):
                    bits.append(True)
                    open_, left = open_ + 1, left - 1
                else:
                    bits.append(False)
                    open_ -= 1
            stack, want = [], {}
            for i, b in enumerate(bits):
                if b:
                    stack.append(i)
                else:
                    want[stack.pop()] = i
            parens = trie.Parens(np.array(bits))
            at = np.flatnonzero(parens.opens)
            assert parens.find_close(at).tolist() == [want[i] for i in at.tolist()]
