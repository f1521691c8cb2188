"""Collocations against a plain version, and fingerprints that collide."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tilth.llm import phrases

SCHEMA = "doc_id long, text string, lang string, score string, fp int, places string, f string"


def plain(rows, fewest, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", brute.lower(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    out = []
    for (lang, w), a in f.items():
        if len(w) < 2 or a < fewest:
            continue
        if any(b >= a and len(v) > len(w) and m == lang and any(v[i : i + len(w)] == w for i in range(len(v))) for (m, v), b in f.items() if b >= fewest):
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.append((lang, " ".join(w), a, left, right, n[lang], score))
    ranked = []
    for lang in {x[0] for x in out}:
        best = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(lang, i + 1, *x[1:]) for i, x in enumerate(best[:top])]
    return sorted(ranked)


def table(spark, rows):
    return spark.createDataFrame([(i % 7, *r, "clash", 1, "clash", None) for i, r in enumerate(rows)], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = ["the", "End", "of", "é", "日本", "x<y", "a\x1cb", "\x00", "\xa0", "zz"]
    ends = [" ", " ", " ", "  ", "\t", ". ", "\n", "\r\n", "!", ";a "]
    made = [("".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(60))), rng.choice(["en", "de", None, ""])) for _ in range(300)]
    made += [("Winter is coming again soon", "en")] * 40 + [("winter is Coming", "de")] * 9 + [(None, "en"), ("", None), (" \t\n.", "en"), ("end of the end of the end", "en")]
    return made + [("the end of it " * 6000, "de")]


def test_collocations(spark, rows):
    for fewest, top in ((8, 2000), (30, 5)):
        got = [tuple(r) for r in phrases.collocations(table(spark, rows), fewest=fewest, top=top).collect()]
        assert sorted(got) == plain(rows, fewest, top) and len(got) > 5


def test_no_phrase_and_no_row(spark):
    assert phrases.collocations(table(spark, [("a b c", "en"), (None, None)])).count() == 0
    assert phrases.collocations(table(spark, [("a b", "en")]).limit(0)).count() == 0


def test_fingerprints_are_those_of_the_words_alone():
    texts, langs = pa.array(["so it goes. it goes on", "it goes", "it goes"]), pa.array(["en", "en", "de"])
    runs = phrases.Runs(texts, langs, 0)
    assert runs.left.tolist() == [3, 2, 1, 3, 2, 1, 2, 1, 2, 1]
    prints = runs.at(np.array([1, 3, 6, 8]), 2).tolist()
    assert prints[0] == prints[1] == prints[2] != prints[3]
    assert runs.at(np.array([1]), 1)[0] != prints[0]


def test_colliding_fingerprints_are_counted_anew(spark, rows, monkeypatch):
    seen = []
    counted = phrases._counted

    def noted(given, lengths, shorter, seed):
        seen.append(seed)
        rows = counted(given, lengths, shorter, seed)
        if seed or 2 not in lengths:
            return rows
        # Two frequent pairs of words fall together.
        two = [r["fp"] for r in rows.filter("n = 2").groupBy("fp").sum("f").orderBy("sum(f)", ascending=False).limit(2).collect()]
        return rows.replace(two[0], two[1], "fp")

    monkeypatch.setattr(phrases, "_counted", noted)
    got = [tuple(r) for r in phrases.collocations(table(spark, rows), fewest=30).collect()]
    assert sorted(got) == plain(rows, 30) and set(seen) == {0, 1}
