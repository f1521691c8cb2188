"""The paths taken on large data, forced on small data and compared with brute force."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilth.functions import hashing
from tilth.functions.quantiles import quantiles
from tilth.operators import balance, fix, forest, neighbors, sampling
from tilth.streaming import streams


@pytest.mark.parametrize("shape", ["uniform", "skewed", "hot", "wide", "constant"])
def test_quantiles_by_ranges_equal_pandas(spark, shape):
    rng = np.random.default_rng(7)
    n = 3000
    x = {
        "uniform": rng.uniform(-5, 5, n),
        "skewed": np.exp(rng.normal(0, 6, n)),
        "hot": np.where(rng.random(n) < 0.4, 3.25, rng.normal(0, 1, n)),
        "wide": np.concatenate([rng.normal(0, 1e-300, n - 2), [-1.7e308, 1.7e308]]),
        "constant": np.full(n, 2.5),
    }[shape]
    t = spark.createDataFrame(pd.DataFrame({"x": x})).repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = quantiles(t, {"x": probs}, gather_rows=20, bins=16)["x"]
    want = pd.Series(x).quantile(probs).tolist()
    assert got == pytest.approx(want, rel=1e-12, abs=0)


def test_hash_rank_equals_window(spark):
    t = spark.range(5000).select("id", F.when(F.col("id") % 10 > 6, F.lit(None)).otherwise(F.col("id") % 3).alias("g"))
    ranked = hashing.hash_ranked(t, ["g"], "id", "s")
    w = W.partitionBy("g").orderBy(hashing.stable_hash("s", "id"), "id")
    plain = t.withColumn("_rank", F.row_number().over(w).cast("long")).withColumn("_size", F.count(F.lit(1)).over(W.partitionBy("g")))
    assert ranked.select("id", "g", "_rank", "_size").exceptAll(plain.select("id", "g", "_rank", "_size")).count() == 0
    assert ranked.count() == 5000
    cut = hashing.hash_ranked(t, ["g"], "id", "s", at_most=40).filter("_rank <= 40")
    assert cut.count() == 160


def test_hash_rank_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(hashing, "START_ROWS", 0)
    t = spark.range(500).select("id", (F.col("id") % 3).alias("g"))
    assert [tuple(r) for r in hashing.hash_ranked(t, ["g"], "id").groupBy("g").agg(F.max("_rank")).orderBy("g").collect()] == [
        (0, 167), (1, 167), (2, 166),
    ]


def test_large_sample_equals_small_path(spark, monkeypatch):
    t = spark.range(1000)
    small = {r[0] for r in sampling.sample_n(t, 300, "id").collect()}
    monkeypatch.setattr(sampling, "TOP_ROWS", 10)
    assert {r[0] for r in sampling.sample_n(t, 300, "id").collect()} == small


@pytest.mark.parametrize("by", [None, "g"])
@pytest.mark.parametrize("fill", [fix.ffill, fix.bfill, fix.interpolate])
def test_blocked_fill_equals_window(spark, fill, by):
    rnd = random.Random(3)
    data = [(i, rnd.choice(["hot", "hot", "hot", "b", None]), float(i) if rnd.random() < 0.1 else None) for i in range(600)]
    t = spark.createDataFrame(data, "i int, g string, x double")
    plain = {r["i"]: r["x"] for r in fill(t, ["x"], "i", by).collect()}
    blocked = {r["i"]: r["x"] for r in fill(t, ["x"], "i", by, group_rows=40).collect()}
    assert blocked.keys() == plain.keys()
    assert all(blocked[i] == pytest.approx(plain[i]) for i in plain)


def _brute(vectors, groups, k):
    out = {}
    for i, v in vectors.items():
        near = sorted(
            (float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), j)
            for j, w in vectors.items() if j != i and groups[i] == groups[j]
        )[:k]
        out[i] = [j for _, j in near]
    return out


@pytest.mark.parametrize("by", [None, "g"])
def test_knn_in_blocks_equals_brute_force(spark, by):
    rng = np.random.default_rng(1)
    points = rng.normal(0, 1, (160, 3)).round(2)
    # A third of all rows are copies of one point.
    points[:55] = points[0]
    vectors = {i: p.tolist() for i, p in enumerate(points)}
    groups = {i: (i * 7) % 3 if by else 0 for i in vectors}
    t = spark.createDataFrame([(i, v, groups[i]) for i, v in vectors.items()], "id long, v array<double>, g long")
    got = {}
    near = neighbors.knn_join(t, t, 4, "id", "id", "v", by=by, exclude_self=True, pivots=9, block_rows=13)
    for r in near.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["donor_id"])
    assert got == _brute(vectors, groups, 4)


def test_knn_with_few_donors(spark):
    q = spark.createDataFrame([(1, [0.0]), (2, [5.0])], "id long, v array<double>")
    d = spark.createDataFrame([(7, [1.0])], "did long, v array<double>")
    assert [tuple(r) for r in neighbors.knn_join(q, d, 3, "id", "did", "v").orderBy("query_id").collect()] == [(1, 7, 1.0, 1), (2, 7, 4.0, 1)]
    assert neighbors.knn_join(q, d.limit(0), 3, "id", "did", "v").count() == 0


def test_knn_keeps_null_groups_apart_and_leaves_odd_vectors_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, [0.0, 0.0]), (2, "", [0.1, 0.0]), (3, None, [3.0, 0.0]), (4, "", [4.0, 0.0]), (5, "a", None), (6, "a", [1.0]), (7, "a", [nan, 0.0]), (8, "a", [inf, 0.0]), (9, "a", [None, 0.0]), (10, "a", [1.0, 2.0]), (11, "a", [1.0, 3.0]), (12, "=", [0.1, 0.1]), (None, "b", [0.0, 0.0]), (13, "b", [0.0, 1.0])]
    t = spark.createDataFrame(rows, "id int, g string, v array<double>")
    near = {(r["query_id"], r["donor_id"]) for r in neighbors.knn_join(t, t, 1, "id", "id", "v", by="g", exclude_self=True).collect()}
    assert {(1, 3), (3, 1), (2, 4), (4, 2), (10, 11), (11, 10)} <= near and not {5, 6, 7, 8, 9, 12} & {x for p in near for x in p}
    assert neighbors.knn_join(t.filter("v is null"), t, 1, "id", "id", "v").count() == 0
    assert neighbors.knn_join(t, t.filter("v is null"), 1, "id", "id", "v").count() == 0


def _counted_pairs(monkeypatch):
    """Rows of both sides in every pair of blocks that meets, as the plan of the joins has them."""
    pairs, compare = [], neighbors._compare

    def counted(visits, placed, keep, width, block_rows):
        v = neighbors.cut(visits.select("_g", "_leaf", "_key", "_v"))
        sizes = placed.groupBy("_g", "_leaf").count()
        pairs.append(v.join(sizes, ["_g", "_leaf"]).agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0])
        return compare(v, placed, keep, width, block_rows)

    monkeypatch.setattr(neighbors, "_compare", counted)
    return pairs


def test_knn_looks_at_few_leaves_of_clustered_rows(spark, monkeypatch):
    rng = np.random.default_rng(7)
    seen = []
    for n in (2000, 8000):
        pairs = _counted_pairs(monkeypatch)
        centres = rng.normal(size=(n // 50, 3)) * 50
        x = centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, 3))
        t = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, v array<double>").repartition(6)
        near = neighbors.knn_join(t, t, 3, "id", "id", "v", exclude_self=True, block_rows=100).collect()
        part = rng.integers(0, n, 40)
        d = np.linalg.norm(x[part][:, None] - x, axis=2)
        d[np.arange(40), part] = np.inf
        got = {(r["query_id"], r["rank"]): r["distance"] for r in near}
        for row, i in zip(d, part.tolist()):
            assert [got[i, k] for k in (1, 2, 3)] == pytest.approx(np.sort(row)[:3].tolist())
        seen.append(sum(pairs) / n)
        monkeypatch.undo()
    # Four times the rows, and not twice as many of them for each query.
    assert seen[1] < 2 * seen[0] and seen[1] < 8000 / 10


def test_smallest_by_products_and_by_differences_agree():
    rng = np.random.default_rng(1)
    for width in (2, 8, 64):
        b = np.concatenate([rng.normal(size=(300, width)), np.ones((60, width)), np.ones((1, width)) * 1e8])
        a = np.concatenate([b[::9], np.ones((3, width)), np.zeros((1, width))])
        want = ((a[:, None] - b) ** 2).sum(axis=2)
        at, squares = neighbors._smallest(a, b, 7)
        assert (at == np.argsort(want, axis=1, kind="stable")[:, :7]).all() and np.allclose(squares, np.sort(want, axis=1)[:, :7], rtol=0, atol=0)


def test_knn_impute_in_blocks(spark):
    rng = np.random.default_rng(2)
    data = [(i, None if i % 7 == 0 else float(rng.integers(0, 9)), None if i % 5 == 0 else float(rng.integers(0, 9)), float(i % 4)) for i in range(120)]
    t = spark.createDataFrame(data, "id long, a double, b double, c double")
    pick = lambda df: sorted(tuple(r) for r in df.collect())
    whole = pick(neighbors.impute_knn(t, "id", ["a", "b", "c"], 3))
    blocks = pick(neighbors.impute_knn(t, "id", ["a", "b", "c"], 3, block_rows=9))
    assert [x[0] for x in whole] == list(range(120)) and all(None not in x for x in whole)
    assert [v for x in whole for v in x] == pytest.approx([v for x in blocks for v in x])


def test_knn_impute_meets_few_blocks_and_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(5)
    n = 1500
    x = np.round(rng.normal(size=(n, 1)) * 40 + rng.normal(size=(n, 3)), 1)
    x[rng.random((n, 3)) < 0.08] = np.nan
    t = spark.createDataFrame([(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)], "id int, a double, b double, c double").repartition(5)
    pairs = _counted_pairs(monkeypatch)
    got = {r["id"]: (r["a"], r["b"], r["c"]) for r in neighbors.impute_knn(t, "id", ["a", "b", "c"], 3, block_rows=40).collect()}
    shared = (~np.isnan(x[:, None] - x)).sum(axis=2)
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.sqrt(np.nansum((x[:, None] - x) ** 2, axis=2) * 3 / shared)
    d[shared == 0] = np.inf
    gaps = np.isnan(x).any(axis=1).sum()
    for i in range(n):
        for f in range(3):
            want = x[i, f]
            if np.isnan(want):
                having = np.flatnonzero(~np.isnan(x[:, f]) & np.isfinite(d[i]))
                best = having[np.argsort(d[i, having], kind="stable")[:3]]
                want = x[best, f].mean() if len(best) else np.nanmean(x[:, f])
            assert got[i][f] == pytest.approx(want), (i, f)
    assert sum(pairs) < gaps * n / 3



def test_oversample_in_chunks(spark, monkeypatch):
    t = spark.createDataFrame([(i, "a") for i in range(50)] + [(i, "b") for i in range(50, 57)], "id long, label string")
    pick = lambda: sorted(tuple(r) for r in balance.oversample(t, "label", "id").collect())
    whole = pick()
    monkeypatch.setattr(balance, "CHUNK_ROWS", 4)
    assert pick() == whole and len(whole) == 100


def test_forest_finds_planted_outliers(spark):
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(0, 1, (2000, 2)), rng.normal(0, 1, (20, 2)) + [12, -12]])
    t = spark.createDataFrame(pd.DataFrame({"id": range(len(x)), "a": x[:, 0], "b": x[:, 1]}))
    first = {r["id"] for r in forest.detect_outliers_isolation_forest(t, ["a", "b"], "id", 0.02).collect()}
    again = {r["id"] for r in forest.detect_outliers_isolation_forest(t.repartition(7), ["a", "b"], "id", 0.02).collect()}
    assert first == again and set(range(2000, 2020)) <= first and len(first) <= 42
    scores = forest.isolation_scores(t, ["a", "b"], "id").agg(F.min("score"), F.max("score")).first()
    assert 0 < scores[0] < scores[1] <= 1
    tiny = t.limit(3).withColumn("a", F.lit(1.0)).withColumn("b", F.lit(1.0))
    assert forest.isolation_scores(tiny, ["a", "b"], "id").count() == 3


def test_wave_stream_in_batches_equals_batch(spark, tmp_path):
    hits = [(str(i % 9), i, [f"q{i % 4}"]) for i in range(90)]
    schema = "id string, pos int, matched_queries array<string>"
    for f in range(3):
        spark.createDataFrame(hits[f * 30 : f * 30 + 30], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    rejected = spark.createDataFrame([("3",)], "id string")
    t = spark.read.schema(schema).parquet(str(tmp_path / "in"))
    stream = lambda: streams.read_stream(spark, str(tmp_path / "in"), t.schema, files_per_batch=1)
    out = str(tmp_path / "out")
    streams.wave_stream(stream(), out, "pos", rejected=rejected)
    got = spark.read.parquet(f"{out}/waves")
    assert sorted(r["id"] for r in got.collect()) == sorted({h[0] for h in hits} - {"3"})
    # Nothing new: a second run changes nothing.
    streams.wave_stream(stream(), out, "pos", rejected=rejected)
    assert spark.read.parquet(f"{out}/waves").count() == 8
    # A file that arrives later only adds unseen ids.
    spark.createDataFrame([("3", 1, ["q"]), ("5", 2, ["q"]), ("77", 3, ["q"])], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    streams.wave_stream(stream(), out, "pos", rejected=rejected)
    assert spark.read.parquet(f"{out}/waves").filter("id = '77'").count() == 1
    assert spark.read.parquet(f"{out}/waves").count() == 9


def test_a_wave_costs_its_own_rows(spark, tmp_path):
    schema = "id string, pos int, matched_queries array<string>"
    for f in range(20):
        rows = [(str((f * 30 + i) // 2), f * 30 + i, [f"q{i}"]) for i in range(30)] + [("hot", 5000 + f * 9 + i, [f"h{f}"]) for i in range(9)] + [(None, 9000 + f, ["n"])]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = streams.read_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema, files_per_batch=1)
    query = streams.wave_stream(stream, str(tmp_path / "out"), "pos")
    waves = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(waves) == 20
    # Each wave reads its 40 rows, and marks its 15 new ids (the first one two more), however many came before.
    assert {p["numInputRows"] for p in waves} == {40}
    assert [p["stateOperators"][0]["numRowsUpdated"] for p in waves] == [17] + [15] * 19
    got = spark.read.parquet(f"{tmp_path}/out/waves")
    assert got.count() == 302 and got.filter("id = 'hot'").first()["batch"] == 0


def test_quantiles_end_on_infinities(spark):
    x = [float("-inf")] * 3 + list(np.linspace(-5, 5, 3000)) + [float("inf")] * 7 + [1.5] * 500
    t = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(4)
    for gather in (20, 20_000):
        got = quantiles(t, {"x": [0.0, 0.1, 0.5, 0.9, 1.0]}, gather_rows=gather, bins=16)["x"]
        assert got[0] == float("-inf") and got[-1] == float("inf")
        assert got[1:-1] == pytest.approx(pd.Series(x).quantile([0.1, 0.5, 0.9]).tolist())
    only = spark.createDataFrame([(float("inf"),), (float("-inf"),), (None,)], "x double")
    assert quantiles(only, {"x": [0.0, 1.0]})["x"] == [float("-inf"), float("inf")]


def test_fills_are_linear_in_a_large_group(spark):
    t = spark.range(200_000).selectExpr("id as i", "case when id % 1000 = 999 then id end as x", "1 as g")
    for by in ("g", None):
        filled = fix.bfill(t, ["x"], "i", by)
        assert filled.filter("x is null or x <> i - i % 1000 + 999").count() == 0
        assert fix.interpolate(t, ["x"], "i", by).filter("i >= 999 and x <> i").count() == 0


def test_row_drops_change_later_statistics(spark):
    t = spark.createDataFrame([(1, None, 1.0), (2, 5.0, 3.0), (3, 6.0, None), (4, 7.0, 11.0)], "i int, a double, b double")
    rows = fix.impute_by_column(t, "a=drop_rows,b=mean", "median").orderBy("i").collect()
    assert [(r["i"], r["b"]) for r in rows] == [(2, 3.0), (3, 7.0), (4, 11.0)]
    with pytest.raises(ValueError):
        fix.impute_by_column(t, "a=drop_rows,c=mean")


def test_knn_of_rows_without_structure_meets_in_few_blocks(spark, monkeypatch):
    """Where leaves exclude little, rows are compared in large blocks: queries are not copied to every leaf."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    t = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, v array<float>").repartition(6)
    met, compare = [], neighbors._compare

    def counted(visits, placed, keep, width, block_rows):
        met.append(visits.count())
        return compare(visits, placed, keep, width, block_rows)

    monkeypatch.setattr(neighbors, "_compare", counted)
    near = neighbors.knn_join(t, t, 3, "id", "id", "v", exclude_self=True, block_rows=100).collect()
    d = np.linalg.norm(x[:, None].astype(float) - x, axis=2)
    np.fill_diagonal(d, np.inf)
    want = {(i, j) for i, row in enumerate(d) for j in np.argsort(row, kind="stable")[:3]}
    assert {(r["query_id"], r["donor_id"]) for r in near} == want
    assert sum(met) <= 3 * 3000, met
