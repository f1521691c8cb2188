"""Learning holds little of a table at a time, leaves no tables behind, and scores a pool without its strings."""

from __future__ import annotations

import os
import weakref
from collections import Counter

import numpy as np
import pyarrow as pa

from tilth.functions import store
from tilth.operators import learn

TEXTS = [None, "", "a b c", "One", "red red red cat red cat", "Straße ﬁ ab‍cd éte x_y 12 3 ab ab", "ΑΣ ΑΣ ok", "the cat the cat the"]


def table(spark):
    return spark.createDataFrame([(i, t, str(i % 2)) for i, t in enumerate(TEXTS * 4)], "id long, text string, label string")


def test_a_fit_asks_for_small_batches_and_removes_its_tables(spark, monkeypatch):
    asked, cut = [], learn.cut
    monkeypatch.setattr(learn, "cut", lambda df: asked.append(spark.conf.get(store.BATCH)) or cut(df))
    folder = store.shared_dir(spark)
    before, bound = set(os.listdir(folder)), spark.conf.get(store.BATCH)
    fitted = learn.fit_text_classifier(table(spark))
    assert asked and set(asked) == {str(store.BATCH_BYTES)}
    assert spark.conf.get(store.BATCH) == bound and set(os.listdir(folder)) == before
    assert fitted.transform(table(spark)).count() == len(TEXTS) * 4


def test_a_batch_is_gone_before_the_next_one_comes():
    def batches(make, seen):
        for _ in range(3):
            batch = make()
            seen.append(weakref.ref(batch))
            yield batch
            del batch
            assert seen[-1]() is None

    words = lambda: pa.record_batch({"id": pa.array([1, 2]), "_terms": pa.array([["ab", "cd"], ["ab"]])})
    counts = lambda: pa.array([[("ab", 1)]], pa.list_(pa.struct([("term", pa.string()), ("n", pa.int32())])))
    vectors = lambda: pa.array([(0, 2, [1], [3.0])], learn._vector_array(2, pa.array([[1]]), pa.array([[3.0]])).type)
    for make, run in ((words, lambda b: learn._counted(b, ["id"], pairs=True)), (counts, learn._vectors(["ab"]).func), (vectors, learn._sublinear.func)):
        seen = []
        assert sum(1 for _ in run(batches(make, seen))) == 3 and len(seen) == 3


def test_only_words_go_to_python_and_pairs_are_counted_there(spark):
    counted = learn.count_terms(table(spark))
    assert "UDF(_words" not in counted._jdf.queryExecution().optimizedPlan().toString()
    got = {r["id"]: {c["term"]: c["n"] for c in r["_counts"]} for r in counted.collect()}
    for i, words in ((1, []), (2, []), (3, ["one"]), (4, "red red red cat red cat".split()), (7, "the cat the cat the".split())):
        assert got[i] == Counter(words) + Counter(map(" ".join, zip(words, words[1:], strict=False)))


def test_packed_terms_score_as_texts_do(spark):
    t = table(spark)
    fitted = learn.fit_text_classifier(t)
    packed = learn.pack_terms(t)
    assert packed.columns == ["id", "text", "label", "_counts"]
    rows = lambda df: {r["id"]: (r["predicted"], list(r["probability"])) for r in df.collect()}
    want, got = rows(fitted.transform(t)), rows(fitted.transform_counted(packed))
    assert want.keys() == got.keys() and all(want[i][0] == got[i][0] and np.allclose(want[i][1], got[i][1]) for i in want)


def test_a_cycle_keeps_no_strings_of_terms_for_its_pool(spark, monkeypatch):
    rows = [(i, f"{'red' if i % 2 else 'blue'} word{i % 5} more{i % 7}", str(i % 2)) for i in range(120)]
    t = spark.createDataFrame(rows, "id long, text string, label string")
    written, cut = [], learn.cut
    monkeypatch.setattr(learn, "cut", lambda df: written.append(df.schema) or cut(df))
    before = set(os.listdir(store.shared_dir(spark)))
    history, _ = learn.run_cycle(t.filter("id < 20"), t.filter("id between 20 and 99"), "id", strategy="margin", n_iterations=2, batch=10, test=t.filter("id > 99"))
    assert [tuple(r) for r in history.collect()] == [(i, 20 + 10 * i, 1.0, 1.0, "margin") for i in range(3)]
    assert {s["_counts"].dataType.simpleString() for s in written if "_counts" in s.names} == {"struct<terms:binary,n:binary>"}
    # Only the ids that were drawn stay.
    assert len(set(os.listdir(store.shared_dir(spark))) - before) == 2
