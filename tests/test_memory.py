"""What Python workers hold at a time does not grow with the batches that reach them."""

from __future__ import annotations

import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from tilth.functions.scalars import word_count
from tilth.operators import learn, search


def peak(call):
    tracemalloc.start()
    try:
        return call(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_terms_are_counted_and_placed_a_piece_at_a_time():
    rng = np.random.default_rng(1)
    rows = [[f"term{i}" for i in rng.integers(0, 3000, 8000)] for _ in range(250)] + [[]]
    batch = pa.record_batch({"id": pa.array(range(251)), "_terms": pa.array(rows)})
    found, mb = peak(lambda: list(learn._counted(iter([batch]), ["id"])))
    assert len(found) > 1 and mb < 60, mb
    counts = {r["id"]: {p["term"]: p["n"] for p in r["_counts"]} for b in found for r in b.to_pylist()}
    assert counts == {i: dict(Counter(r)) for i, r in enumerate(rows)}
    lists = pa.concat_arrays([b.column("_counts") for b in found])
    vectors, mb = peak(lambda: list(learn._vectors(["term7", "term3", "other"]).func(iter([lists]))))
    assert len(vectors) > 1 and mb < 60, mb
    for got, row in zip((v for a in vectors for v in a.to_pylist()), rows, strict=True):
        n = [Counter(row)[t] for t in ("term7", "term3", "other")]
        assert got["size"] == 3 and got["indices"] == [i for i in range(3) if n[i]]
        assert np.allclose(got["values"], [1 + np.log(x) for x in n if x])


def test_kernel_features_leave_a_piece_at_a_time():
    kernel = learn.Kernel(0.7, 5)
    rng = np.random.default_rng(3)
    dense = rng.normal(size=(10_000, 5))
    dense[:, 1:4:2] *= rng.integers(0, 2, (10_000, 2))
    kept = [np.flatnonzero(r) if i % 2 else None for i, r in enumerate(dense)]
    batch = pa.array(
        [
            {"type": 1, "size": None, "indices": None, "values": r} if k is None else {"type": 0, "size": 5, "indices": k, "values": r[k]}
            for r, k in zip(dense, kept, strict=True)
        ],
        pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))]),
    )
    along, phase = learn._directions(kernel)
    wanted = np.cos(dense @ along + phase) * np.sqrt(2 / kernel.features)

    def run():
        """Rows that came, largest piece and largest error; no piece outlives the next."""
        at = most = off = 0
        for piece in learn._fourier(kernel).func(iter([batch])):
            found = np.asarray(piece.field("values").flatten()).reshape(len(piece), kernel.features)
            off = max(off, np.abs(found - wanted[at : at + len(piece)]).max())
            at, most = at + len(piece), max(most, len(piece))
        return at, most, off

    (rows, most, off), mb = peak(run)
    assert rows == 10_000 and most * kernel.features <= learn.PIECE and off < 1e-9
    # All features of the batch are 41 MB.
    assert mb < 20, mb


def test_bm25_counts_a_piece_at_a_time():
    fields = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("words", T.LongType()), T.StructField("at", T.ArrayType(T.IntegerType())),
        T.StructField("tf", T.ArrayType(T.IntegerType())), T.StructField("term", T.StringType()), T.StructField("df", T.LongType()),
    ])
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 500, 1500)) for _ in range(2000)] + [None, ""]
    batch = pa.record_batch({"id": pa.array(range(2002)), "text": pa.array(texts)})
    found, mb = peak(lambda: list(search._counted(iter([batch]), fields, pa.array(["w3", "none", "w5"]))))
    assert mb < 60, mb
    rows = [r for b in found for r in b.to_pylist()]
    docs, words = [r for r in rows if r["term"] is None], [r for r in rows if r["term"] is not None]
    plain = [Counter((t or "").split()) for t in texts]
    assert [(r["id"], r["words"], dict(zip(r["at"], r["tf"], strict=True))) for r in docs] == [
        (i, c.total(), {a: c[t] for a, t in ((0, "w3"), (2, "w5")) if c[t]}) for i, c in enumerate(plain)
    ]
    # A word of the vocabulary leaves once, not once for each piece.
    assert len(words) == 500 and {r["term"]: r["df"] for r in words} == Counter(t for c in plain for t in c)


def test_words_of_a_text_are_counted_without_an_array(spark):
    texts = ["a  b\tc\n", "", " \n", None, "x", "été   z", " lead and trail "]
    counted = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string").select("id", word_count("t").alias("n"))
    assert [r["n"] for r in counted.orderBy("id").collect()] == [3, 0, 0, None, 1, 3, 3]
    assert "split(" not in counted._jdf.queryExecution().optimizedPlan().toString()
