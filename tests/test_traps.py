"""Edge cases: nulls, ties, one class, all-null columns, empty input, no spread."""

from __future__ import annotations

import datetime as dt
import json
import struct

import pytest
from pyspark.sql import functions as F

from tilth.functions import scalars as S
from tilth.operators import agree, combine, compare, detect, fix, label, learn, media, profile, sampling
from tilth.operators import search
from tilth.operators.balance import class_weights, oversample
from tilth.plans import quality, stages
from tilth.sources import collect, pages, readers, writers


def rows(df):
    return [tuple(r) for r in df.collect()]


def one(df):
    return df.first().asDict()


# --- missing values and severity ---


def test_all_null_columns_are_not_missing_data(spark):
    t = spark.createDataFrame([(1, None, "a"), (None, None, "b")], "x int, audio string, y string")
    assert rows(detect.detect_missing_active(t)) == [("x", 1, 50.0, 25.0)]
    assert detect.empty_columns(t) == ["audio"]
    assert one(detect.missing_totals(t))["missing_cells"] == 3
    report = {(r["issue"], r["column"]): r for r in detect.quality_report(t).collect()}
    assert ("skipped_empty", "audio") in report and ("missing", "audio") not in report


def test_severity_is_strict(spark):
    v = spark.createDataFrame([(3.0,), (3.01,), (10.0,), (20.0,), (20.5,)], "v double")
    got = [r[0] for r in v.select(S.severity(F.col("v"), S.IMBALANCE_RATIO)).collect()]
    assert got == ["low", "medium", "medium", "high", "critical"]


def test_nan_is_missing_and_never_an_outlier(spark):
    t = spark.createDataFrame([(float(i),) for i in range(1, 11)] + [(100.0,), (float("nan"),)], "x double")
    assert rows(detect.detect_missing(t))[0][:2] == ("x", 1)
    r = one(detect.detect_outliers_iqr(t))
    assert (r["outlier_count"], r["max_value"]) == (1, 100.0)
    assert fix.impute(t, "mean").filter(F.isnan("x")).count() == 0


def test_iqr_fences_and_threshold_zero(spark):
    t = spark.createDataFrame([(float(i),) for i in range(1, 11)] + [(100.0,)], "x double")
    r = one(detect.detect_outliers_iqr(t, k=0))
    assert r["threshold"] == 1.5
    assert (r["lower_bound"], r["upper_bound"], r["outlier_count"]) == (-4.0, 16.0, 1)
    assert max(x for (x,) in rows(fix.clip_iqr(t))) == 16.0


def test_no_spread_means_no_outliers(spark):
    t = spark.createDataFrame([(5.0,)] * 3, "x double")
    assert rows(detect.detect_outliers_zscore(t)) == []
    assert rows(fix.clip_zscore(t)) == [(5.0,)] * 3
    assert fix.drop_outliers(t, method="zscore").count() == 3


def test_sequential_drop_recomputes_bounds(spark):
    t = spark.createDataFrame(
        [(float(i), float(i)) for i in range(10)] + [(1000.0, 40.0), (5.0, 22.0)], "a double, b double"
    )
    joint = set(rows(fix.drop_outliers(t, ["a", "b"])))
    step = set(rows(fix.drop_outliers_sequential(t, ["a", "b"])))
    assert step <= joint and (1000.0, 40.0) not in joint


def test_clip_report_does_not_count_nulls(spark):
    t = spark.createDataFrame([(None,)] + [(float(i),) for i in range(10)] + [(99.0,)], "x double")
    assert one(fix.clip_report(t, detect.iqr_bounds(t, ["x"])))["clipped"] == 1


# --- duplicates ---


def test_keep_none_and_null_equals_null(spark):
    t = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None)], "id int, v string")
    assert rows(combine.dedupe(t, "id", ["v"], "none")) == [(3, "b")]
    assert sorted(rows(combine.dedupe(t, "id", ["v"], "first"))) == [(1, "a"), (3, "b"), (4, None)]
    assert sorted(r[0] for r in rows(combine.dedupe(t, "id", ["v"], "last"))) == [2, 3, 5]
    assert one(detect.detect_duplicates(t, ["v"], "none"))["duplicate_rows"] == 4
    samples = rows(detect.duplicate_samples(t, ["v"], "id"))
    assert [r[0] for r in samples] == [2, 5]


# --- imputation ---


def test_mode_takes_the_smallest_on_ties(spark):
    t = spark.createDataFrame([(v,) for v in ["b", "a", "a", "b", None]], "v string")
    assert rows(fix.impute_mode(t))[-1] == ("a",)


def test_mean_and_mode_differ_on_all_null_columns(spark):
    t = spark.createDataFrame([(1, None), (None, None)], "x int, note string")
    assert rows(fix.impute(t, "median"))[1] == (1, None)
    assert rows(fix.impute_mode(t, fill_empty=True))[1] == (1, "unknown")


def test_drop_rows_ignores_unused_modalities(spark):
    t = spark.createDataFrame([(1, None), (None, None)], "x int, audio string")
    assert rows(fix.drop_rows(t)) == [(1, None)]


def test_constant_by_type(spark):
    t = spark.createDataFrame([(None, None)], "x double, v string")
    assert rows(fix.fill_constant(t)) == [(0.0, "unknown")]
    assert rows(fix.fill_constant(t, "7")) == [(7.0, "7")]
    assert rows(fix.fill_constant(t, "none")) == [(None, "none")]


def test_fills_along_an_order(spark):
    t = spark.createDataFrame(list(enumerate([None, 1.0, None, None, 4.0, None])), "i int, x double")
    fill = lambda f: [x for _, x in sorted(rows(f(t, ["x"], "i")))]
    assert fill(fix.ffill) == [None, 1.0, 1.0, 1.0, 4.0, 4.0]
    assert fill(fix.bfill) == [1.0, 1.0, 4.0, 4.0, 4.0, None]
    assert fill(fix.interpolate) == [None, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_impute_by_column_strategies(spark):
    t = spark.createDataFrame(
        [(1, 1.0, "a", None), (2, None, None, 3.0), (3, 4.0, "b", 5.0), (4, 7.0, "b", 7.0)],
        "id int, x double, v string, y double",
    )
    got = dict((r["id"], r) for r in fix.impute_by_column(t, "x=interpolate,y=constant:9", "median", order="id").collect())
    assert (got[2]["x"], got[2]["v"], got[1]["y"]) == (2.5, "b", 9.0)
    assert fix.impute_by_column(t, {"v": "drop_rows"}).count() == 3
    assert "v" not in fix.impute_by_column(t, {"v": "drop_col"}).columns
    kept = fix.impute_by_column(t, "", "mean", only_numeric=True).filter("v is null")
    assert kept.count() == 1
    assert fix.impute_by_column(t, {"v": "mode"}, "knn", id_col="id").filter("x is null or y is null").count() == 0


# --- classes ---


def test_one_class_and_null_labels(spark):
    t = spark.createDataFrame([("a",), ("a",), (None,)], "label string")
    assert one(detect.imbalance(t, "label"))["ratio"] == 1.0
    assert one(detect.imbalance(t, None))["ratio"] is None
    r = one(detect.detect_imbalance(t, "label"))
    assert (r["total_rows"], r["num_classes"], r["missing_labels"], r["majority_pct"]) == (3, 1, 1, 66.67)
    weights = {x["label"]: x["weight"] for x in class_weights(t, "label").collect()}
    assert weights == {"a": 0.75, None: 1.5}


def test_balancing_drops_null_labels(spark):
    t = spark.createDataFrame([(i, "a") for i in range(6)] + [(10, "b"), (11, None)], "id int, label string")
    assert sorted(r[1] for r in rows(sampling.undersample(t, "label", "id"))) == ["a", "b"]
    over = rows(oversample(t, "label", "id").groupBy("label").count())
    assert sorted(over) == [("a", 6), ("b", 6)]


def test_tiny_class_stays_in_train(spark):
    t = spark.createDataFrame([(i, "a") for i in range(10)] + [(99, "b")], "id int, label string")
    split = {(r["label"], r["split"]): r["count"] for r in sampling.stratified_split(t, "label", "id").groupBy("label", "split").count().collect()}
    assert split == {("a", "test"): 2, ("a", "train"): 8, ("b", "train"): 1}


def test_seed_leaves_one_batch(spark):
    t = spark.range(30).withColumnRenamed("id", "i")
    seed, pool = sampling.seed_and_pool(t, "i", 50, 20)
    assert (seed.count(), pool.count()) == (10, 20)


# --- labels and review ---


def test_blank_text_and_threshold_edge(spark):
    t = spark.createDataFrame(
        [("x", "p", 0.75), ("x", "p", 0.7499), ("\t \n", "p", 0.9), (None, "p", 0.9)], "text string, label string, confidence double"
    )
    got = rows(label.flag_low_confidence(t))
    assert [(r[1], r[2], r[3]) for r in got] == [
        ("p", 0.75, False), ("p", 0.7499, True), (None, 0.0, True), (None, 0.0, True),
    ]


def test_auto_label_contract(spark):
    seen = spark.sparkContext.accumulator(0)

    def make():
        def scorer(texts, labels):
            import numpy as np

            seen.add(max(0, len(texts) - 8))
            assert "." in set(texts) or all(t.strip() for t in texts)
            return np.array([[0.9, 0.1] if "good" in t else [0.3, 0.7] for t in texts])

        return scorer

    t = spark.createDataFrame([(i, "good" if i % 2 else "bad", "gold") for i in range(20)] + [(99, " ", "gold")], "id int, text string, label string")
    got = {r["id"]: r for r in label.auto_label(t, ["pos", "neg"], make).collect()}
    assert (got[1]["label"], got[1]["confidence"], got[1]["flagged_for_review"]) == ("pos", 0.9, False)
    assert (got[2]["label"], got[2]["flagged_for_review"], got[2]["human_label"]) == ("neg", True, "gold")
    assert (got[99]["label"], got[99]["confidence"]) == (None, 0.0)
    assert seen.value == 0


def test_corrections(spark):
    labelled = spark.createDataFrame(
        [("t1", "a", True), ("t1", "a", True), ("t2", "a", True), ("t3", "a", True), ("t4", "a", True)],
        "text string, label string, flagged_for_review boolean",
    )
    queue = spark.createDataFrame(
        [(1, "t1", "c"), (2, "t1", "b"), (3, "t2", "odd"), (4, "t3", "a"), (5, "t4", None)], "pos int, text string, label string"
    )
    got = sorted(rows(combine.apply_corrections(labelled, queue, ["a", "b", "c"], position="pos")))
    assert got == [
        ("t1", "b", False, True), ("t1", "b", False, True), ("t2", "a", True, False), ("t3", "a", True, False), ("t4", "a", True, False),
    ]


def test_kappa_edges(spark):
    def kappa(pairs):
        return one(agree.cohen_kappa(spark.createDataFrame(pairs, "a string, b string"), "a", "b"))["kappa"]

    assert kappa([("x", "x"), ("y", "y")]) == 1.0
    assert kappa([("x", "x"), ("x", "x")]) is None
    assert kappa([("x", "x"), ("x", None)]) is None


def test_evaluate_without_known_labels(spark):
    t = spark.createDataFrame([("a", "a"), ("b", "a")], "l string, p string")
    known = spark.createDataFrame([("z",)], "l string")
    assert one(agree.evaluate(t, "l", "p", known)) == {"rows": 0, "accuracy": 0.0, "f1": 0.0}
    r = one(agree.evaluate(t, "l", "p", spark.createDataFrame([("a",)], "l string")))
    assert (r["rows"], r["accuracy"], r["f1"]) == (1, 1.0, 1.0)


def test_confusion_matrix_lists_all_labels(spark):
    t = spark.createDataFrame([("a", "b"), ("a", "a")], "t string, p string")
    assert rows(agree.confusion_matrix(t, "t", "p", ["b", "a"])) == [("a", 1, 1), ("b", 0, 0)]


# --- verdicts and catalogs ---


def test_verdicts(spark):
    c = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    v = spark.createDataFrame([("a", True, "s"), ("b", None, None)], "id string, keep boolean, summary string")
    kept, rejected = combine.apply_verdicts(c, v)
    assert rows(kept) == [("a", "s")] and rows(rejected) == [("b",)]
    assert rows(combine.unjudged(c, v)) == [("c",)]
    kept, rejected = combine.apply_verdicts(c, None)
    assert kept.count() == 3 and rejected.count() == 0
    assert combine.rerank(c, None, "id") is c
    assert rows(combine.final_selection(c, None, "id")) == [("a",), ("b",), ("c",)]


def test_catalog_merge_counts_only_collisions(spark):
    t = spark.createDataFrame(
        [("a", 1, 1, ["q"], 7), ("b", 1, 2, ["q"], 5), ("b", 2, 1, ["r", "q"], 5), ("", 2, 2, ["z"], 9)],
        "id string, file int, pos int, matched_queries array<string>, query_match_count int",
    )
    got = {r["id"]: (r["matched_queries"], r["query_match_count"]) for r in combine.catalog_merge(t, ["file", "pos"]).collect()}
    assert got == {"a": (["q"], 7), "b": (["q", "r"], 2)}


def test_verification_keeps_unknown(spark):
    c = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")
    v = spark.createDataFrame(
        [("a", True), ("b", False), ("c", None)], "id string, pass boolean"
    ).selectExpr("*", "'en' as language", "'2' as num_classes", "'' as reason")
    kept, rejected = combine.verification_gate(c, v)
    assert sorted(r["id"] for r in kept.collect()) == ["a", "c", "d"] and rows(rejected) == [("b",)]
    assert one(combine.wave_needed(kept, 4)) == {"passed": 3, "another_wave": True}


# --- text ---


def test_words_and_counts(spark):
    t = spark.createDataFrame([("café it's The end",), ("",)], "t string")
    got = rows(t.select(S.words("t"), S.word_count("t")))
    assert got[0][0] == ["s", "end"] and got[1] == ([], 0)


def test_model_replies(spark):
    replies = ['[1]', '```json\n{"a": 1}\n```', 'hm ```\n[2]\n``` bye', '<think>{"a":0}</think> {"a": 2}', "nonsense", None]
    t = spark.createDataFrame([(r,) for r in replies], "t string")
    got = [r[0] for r in t.select(S.parse_model_json(F.col("t")).cast("string")).collect()]
    assert got == ["[1]", '{"a":1}', "[2]", '{"a":2}', None, None]


def test_bm25_edges(spark):
    docs = spark.createDataFrame([("a", "common rare rare"), ("b", "common"), ("c", "common other"), ("d", "")], "id string, t string")
    score = lambda *q: {r["id"]: r["score"] for r in search.bm25(docs, search.terms_of(spark, q), "id", "t").collect()}
    once, twice = score("rare"), score("rare rare")
    assert twice["a"] == pytest.approx(2 * once["a"]) and once["d"] == 0.0
    # In three of four documents: negative idf is replaced by a share of the mean, so the score is positive.
    assert score("common")["b"] > 0 and score("absent") == {"a": 0, "b": 0, "c": 0, "d": 0}
    assert search.bm25(docs.limit(0), search.terms_of(spark, ["x"]), "id", "t").count() == 0


def test_html(spark):
    html = """<p>one <b>two</b><p class="x y"> three &amp; </p><script>var t='<p>no</p>'</script><!-- <p>no</p> --><p>  </p>
    <div id="m"><p>four</div><p>five<br>six"""
    assert [t.strip() for t in pages.select_text(html, "p")] == ["one two", "three &", "", "four", "fivesix"]
    assert [t.strip() for t in pages.select_text(html, "p.x")] == ["three &"]
    assert [t.strip() for t in pages.select_text(html, "#m")] == ["four"]
    t = spark.createDataFrame([("u", html), ("v", None)], "url string, html string")
    assert [r["text"] for r in pages.extract_html(t).orderBy("position").collect()] == ["one two", "three &", "four", "fivesix"]


# --- sources and sinks ---


def test_reading_and_writing(spark, tmp_path):
    t = spark.createDataFrame([(1, 'a "q",\nb'), (2, None)], "id int, v string")
    for suffix in ("csv", "parquet", "jsonl"):
        path = writers.write_any(t, str(tmp_path / f"t.{suffix}"))
        assert sorted(rows(readers.read_any(spark, path).select("id", "v"))) == sorted(rows(t))
        with pytest.raises(Exception):
            writers.write_any(t, path)
    (tmp_path / "doc.json").write_text(json.dumps([{"id": 1, "v": "x"}, {"id": 2}]))
    assert rows(readers.read_any(spark, str(tmp_path / "doc.json")).select("id", "v")) == [(1, "x"), (2, None)]
    with pytest.raises(ValueError):
        readers.read_any(spark, "t.xyz")


def test_files(spark, tmp_path):
    import struct
    import wave

    for name in ("cat", "dog"):
        (tmp_path / name).mkdir()
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + struct.pack(">II", 4, 3)
    (tmp_path / "cat" / "a.png").write_bytes(png)
    (tmp_path / "dog" / "b.PNG").write_bytes(png)
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08" + struct.pack(">HH", 5, 6) + b"\0" * 8
    (tmp_path / "dog" / "c.jpg").write_bytes(jpeg)
    (tmp_path / "dog" / "broken.bmp").write_bytes(b"BM")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path))
    r = one(media.profile_images(files))
    assert (r["total_files"], r["num_classes"], r["count_sampled"], r["unique_sizes"]) == (4, 2, 3, 2)
    assert (r["width_min"], r["width_max"], r["height_max"]) == (4, 6, 5)
    assert rows(media.class_sizes(files, readers.IMAGE_SUFFIXES)) == [("dog", 3), ("cat", 1)]
    assert rows(readers.detect_modality(readers.files_inventory(spark, str(tmp_path)))) == [("image",)]

    sounds = tmp_path / "sounds"
    sounds.mkdir()
    with wave.open(str(sounds / "s.wav"), "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(8000)
        w.writeframes(b"\0\0" * 4000)
    (sounds / "x.mp3").write_bytes(b"ID3")
    (sounds / "t.txt").write_text("three words here\n")
    r = one(media.profile_audio(spark.read.format("binaryFile").load(str(sounds))))
    assert (r["total_files"], r["count_sampled"], r["seconds_mean"]) == (2, 1, 0.5)
    assert rows(readers.detect_modality(readers.files_inventory(spark, str(sounds)))) == [("audio",)]
    text = readers.read_text_dir(spark, str(sounds))
    assert one(profile.profile_text_dir(text))["words_mean"] == 3.0


def test_media_headers_are_read_by_sql_and_little_goes_to_python(spark):
    """PNG, BMP, GIF and plain WAVE never reach Python; a JPEG gives its first bytes, all of it only if these do not do."""
    tail = bytes(300_000)
    png = b"\x89PNG\r\n\x1a\n" + bytes(8) + struct.pack(">II", 3000, 70_000) + tail
    bmp = b"BM" + bytes(16) + struct.pack("<ii", -40, 50) + tail
    gif = b"GIF89a" + struct.pack("<HH", 7, 9) + tail
    frame = b"\xff\xc0\x00\x11\x08" + struct.pack(">HH", 20, 10) + bytes(10)
    near, far = b"\xff\xd8" + frame + tail, b"\xff\xd8" + (b"\xff\xe1\xff\xff" + bytes(65_533)) * 2 + frame
    images = spark.createDataFrame([(bytearray(x),) for x in (png, bmp, gif, near, far, b"\xff\xd8\xff", b"", png[:20], tail)] + [(None,)], "content binary")
    assert sorted(rows(media.image_sizes(images))) == [(7, 9), (10, 20), (10, 20), (40, 50), (3000, 70_000)]
    head, whole = media.to_python(F.col("content"), media.plain_size(F.col("content")), *media.IMAGES_BY_PYTHON)
    assert one(images.select(F.sum(F.octet_length(head)).alias("n")))["n"] == 2 * media.HEAD + 3
    def wav(rate, size, *chunks):
        return b"RIFF" + bytes(4) + b"WAVE" + b"".join(chunks) + b"fmt " + struct.pack("<IHHIIHH", 16, 1, 1, 8000, rate, 2, 16) + b"data" + struct.pack("<I", size) + bytes(400)
    sounds = spark.createDataFrame([(bytearray(x),) for x in (wav(16_000, 8_000), wav(0, 8), wav(100, 50, b"LIST" + struct.pack("<I", 4) + b"abcd"), b"RIFF", tail)] + [(None,)], "content binary")
    assert sorted(r[0] for r in rows(media.sound_seconds(sounds))) == [0.5, 0.5]
    head, _ = media.to_python(F.col("content"), media.plain_seconds(F.col("content")), *media.SOUNDS_BY_PYTHON)
    assert one(sounds.select(F.sum(F.octet_length(head)).alias("n")))["n"] < 1000


def test_column_guess_and_mapping(spark):
    t = spark.createDataFrame([("h", "pos")], "news_headline string, sentiment string")
    assert rows(collect.load_dataset(t, "n").select("text", "label")) == [("h", None)]
    mapped = collect.load_dataset(t, "n", text_col="news_headline", label_col="sentiment", collected_at=dt.datetime(2024, 1, 1))
    assert rows(mapped.select("text", "label", "source")) == [("h", "pos", "hf:n")]


def test_api_bodies(spark):
    bodies = ['[{"a": {"b": 1}}]', '{"results": [{"a": {"b": 2}}]}', '{"data": [{"a": {"b": 3}}]}', '{"items": [{"a": {"b": 4}}]}', '{"a": {"b": 5}}']
    t = spark.createDataFrame([(b,) for b in bodies], "body string")
    flat = collect.flatten_api(t, "body", "struct<a: struct<b: int>>", "e")
    assert sorted(r["a.b"] for r in flat.collect()) == [1, 2, 3, 4, 5]
    assert flat.first()["source"] == "api:e"


def test_tasks_without_label_have_no_prediction(spark):
    t = spark.createDataFrame([(1, "x", None, 0.5, True), (2, "y", "a", 0.9, False)], "id int, text string, label string, confidence double, flagged_for_review boolean")
    got = {r["id"]: json.loads(r["j"]) for r in writers.labeling_tasks(t, "id").select("id", F.to_json(F.struct("*")).alias("j")).collect()}
    assert "predictions" not in got[1]
    assert got[2]["predictions"][0]["result"][0]["value"]["choices"] == ["a"]


def test_empty_queue_replaces_an_old_one(spark, tmp_path):
    t = spark.createDataFrame([(1, True)], "id int, flagged_for_review boolean")
    path = str(tmp_path / "queue")
    writers.write_review_queue(t, path)
    writers.write_review_queue(t.withColumn("flagged_for_review", F.lit(False)), path)
    assert spark.read.schema("id int, flagged_for_review boolean").csv(path, header=True).count() == 0


# --- comparison and cleaning ---


def test_compare_formats(spark):
    before = spark.createDataFrame([(1, None, None), (1, None, None), (2, "x", None)], "n int, v string, audio string")
    got = {r["metric"]: tuple(r)[1:] for r in compare.compare(before, before.dropDuplicates()).collect()}
    assert got["rows"] == (3, 2, "-1", "-33.3%")
    assert got["missing_values"] == (2, 1, "-1", "")
    assert got["duplicates"] == (1, 0, "-1", "")
    assert got["outliers_n"] == (0, 0, "+0", "")


def test_fix_with_balance_and_strategies(spark):
    t = spark.createDataFrame(
        [(i, float(i % 7), "a" if i % 5 else "b") for i in range(20)] + [(20, None, "a"), (21, 500.0, "a")], "id int, x double, label string"
    )
    out = quality.fix(t, "id", {"duplicates": "skip", "imbalance": "undersample"}, label_col="label")
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts["a"] == counts["b"] == 4
    assert quality.fix(t, "id", {"outliers": "drop", "missing": "drop_rows"}).filter("x is null or x > 100").count() == 0
    assert quality.fix(t, "id", {"missing": "ffill", "outliers": "clip_zscore"}).filter("x is null").count() == 0
    assert quality.strategy_for("regression")["missing"] == "median"


# --- learning ---


def test_uncertainty_orders(spark):
    t = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.9, 0.1]), (3, [0.5, 0.5])], "id int, probability array<double>")
    assert [r["id"] for r in learn.query(t, "entropy", 2, "id").collect()] == [1, 3]
    t = spark.createDataFrame([(1, [0.45, 0.45, 0.1]), (2, [0.4, 0.3, 0.3])], "id int, probability array<double>")
    assert learn.query(t, "margin", 1, "id").first()["id"] == 1
    assert learn.query(t, "entropy", 1, "id").first()["id"] == 2
    assert learn.query(t, "random", 5, "id").count() == 2
    with pytest.raises(ValueError):
        learn.query(t, "other", 1, "id")


def test_savings_edges(spark):
    h = lambda *f1: spark.createDataFrame([(i, 50 + 20 * i, f, f, "s") for i, f in enumerate(f1)], learn.HISTORY)
    assert one(learn.savings(h(0.1, 0.2), h(0.1, 0.5)))["labels_saved"] is None
    r = one(learn.savings(h(0.6, 0.2), h(0.1, 0.5)))
    assert (r["entropy_reached_same_quality_at_n"], r["labels_saved"], r["savings_pct"]) == (50, 20, 28.6)


def test_classifier_learns_and_reloads(spark, tmp_path):
    words = {"pos": "great fine lovely", "neg": "awful bad poor", "neu": "plain table chair"}
    t = spark.createDataFrame([(i, f"{w} item {i % 3}", k) for k, w in words.items() for i in range(12)], "id int, text string, label string")
    for kind in ("logreg", "svm"):
        model = learn.fit_text_classifier(t, model=kind)
        assert model.transform(t).filter("predicted = label").count() == 36
        p = model.transform(t).first()["probability"]
        assert sum(p) == pytest.approx(1.0)
    model.save(str(tmp_path / "m"))
    again = learn.TextClassifier.load(str(tmp_path / "m"))
    assert again.labels == ["neg", "neu", "pos"]
    assert learn.score_new(again, t).select("label", "confidence").exceptAll(learn.score_new(model, t).select("label", "confidence")).count() == 0
    with pytest.raises(ValueError):
        learn.fit_text_classifier(t.filter("label = 'pos'"))
    seed = learn.stratified_seed(t.withColumn("id", F.monotonically_increasing_id()), "label", "id", 2)
    assert seed.count() == 6


def test_stages(spark):
    words = {"pos": "great fine", "neg": "awful bad", "neu": "plain table"}
    data = [(i * 3 + j, f"{w} item {i % 7}{i}", k, f"s{i % 2}") for i in range(20) for j, (k, w) in enumerate(words.items())]
    t = spark.createDataFrame(data + [(900, "odd", "other", "s0"), (901, None, "pos", "s0")], "id int, text string, label string, source string")
    collected = stages.collect_stage(t, "id", {}, list(words), cap=24)
    assert {r["source"]: r["count"] for r in collected.groupBy("source").count().collect()} == {"s0": 24, "s1": 24}
    cleaned, report, comparison = stages.quality_stage(collected, "id", n=10)
    assert max(r["count"] for r in cleaned.groupBy("label").count().collect()) <= 10
    assert comparison.filter("metric = 'rows'").first()["before"] == 48 and report.filter("issue = 'overall'").count() == 1
    tasks, queue = stages.export_stage(
        cleaned.withColumns({"confidence": F.lit(0.5), "flagged_for_review": F.col("id") % 2 == 0}), "id"
    )
    assert tasks.count() == cleaned.count() and queue.filter("id % 2 = 1").count() == 0
    learned = stages.learning_stage(t, "id", list(words), n_start=12, n_iterations=1, batch=5)
    curve = {(r["strategy"], r["iteration"]): r["n_labeled"] for r in learned.curve.collect()}
    assert curve == {("entropy", 0): 12, ("entropy", 1): 17, ("random", 0): 12, ("random", 1): 17}
    assert learned.saved.first()["random_final_n_labeled"] == 17


def test_empty_input(spark):
    t = spark.createDataFrame([], "id int, x double, text string, label string")
    assert rows(detect.detect_missing(t)) == [] and rows(detect.detect_outliers_iqr(t)) == []
    assert one(detect.detect_duplicates(t))["duplicate_rows"] == 0
    assert one(detect.detect_imbalance(t, "label"))["num_classes"] == 0
    assert one(profile.profile_text(t))["len_max"] is None
    for op in (fix.impute, fix.impute_mode, fix.clip_iqr, fix.drop_outliers, fix.filter_by_length_iqr, fix.drop_rows):
        assert op(t).count() == 0
    assert combine.dedupe(t, "id", ["text"]).count() == 0
    assert sampling.undersample(t, "label", "id").count() == 0
    assert oversample(t, "label", "id").count() == 0
    assert one(agree.cohen_kappa(t, "label", "text"))["kappa"] is None
    assert rows(profile.histogram(t, "x")) == []


def test_selectors_combine_or_raise():
    from tilth.sources.pages import select_text

    page = "<article id=m><p>a</p><div class='x y'><p>b</p><a href='/q'>c</a></div></article><p>d</p><ul><li lang=en-GB>e</li></ul>"
    assert select_text(page, "article p") == ["a", "b"]
    assert select_text(page, "#m > p") == ["a"]
    assert select_text(page, "p, li") == ["a", "b", "d", "e"]
    assert select_text(page, "div.x.y > a[href^='/']") == ["c"]
    assert select_text(page, "li[lang|=en]") == ["e"] and select_text(page, "*[href]") == ["c"]
    for wrong in ("p:first-child", "p + p", "p >", "", "p,,a"):
        with pytest.raises(ValueError):
            select_text(page, wrong)
