"""Places where an operator once did less than the whole job."""

from __future__ import annotations

import random
import time

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tilth.llm import html_text, shards, urls

FOLDER = "/root/testdata/sf0.001"


def test_signs_above_an_article_do_not_discard_it():
    text = "<p>The story of the day is long enough.</p>"
    around = "<div class='sidebar'><p>Aside</p></div>"
    pages = [
        f"<body class='single no-sidebar'><article>{text}</article>{around}",
        f"<body class='sidebar'><article>{text}</article>{around}",
        f"<div class='has-sidebar'>{text}</div>{around}",
        f"<div class='page-with-sidebar'><article>{text}</article>{around}</div>",
        f"<article class='post comments-open'>{text}</article>{around}",
        f"<article class='post share'>{text}</article>{around}",
        f"<form><main><article>{text}</article></main>{around}</form>",
        f"<main><h1>Title</h1><form><article>{text}</article></form></main>",
        f"<form action=x><div>{text}</div>{around}</form>",
        f"<div id='widget'><article>{text}<section class='comments'><article><p>me too</p></article></section></article></div>",
        f"<article data-class='comments' data-id='menu' title='x class=nav'>{text}</article>",
    ]
    story = "The story of the day is long enough."
    assert [html_text.extract(p, set()).removeprefix("Title\n\n") for p in pages] == [story] * len(pages)
    # What is not the article stays out.
    others = [
        f"<div>{text}</div><section class='comments'><article class='comment'><p>me too</p></article></section>",
        f"<article>{text}</article><div class='comments'><article><p>{'a longer answer ' * 9}</p></article></div>",
        f"<div>{text}</div><form><p>Your address</p></form><nav class=x><p>{'Home ' * 40}</p></nav>",
    ]
    assert [html_text.extract(p, set()) for p in others] == [story] * len(others)


def test_deep_and_very_long_pages_take_time_in_proportion():
    """A megabyte of nested elements, of any kind, and a megabyte of text."""
    deep = "<div>x" * 150_000
    spans = "<p><div>" + "<span>" * 60_000 + "<li>y" * 60_000
    tables = "<table><tr><td>z" * 40_000
    text = "<article><p>" + "word &amp; " * 100_000 + "</p></article><p>end"
    began = time.time()
    assert html_text.extract(deep, set()).count("x") == 150_000
    assert html_text.extract(spans, set()).count("y") == 60_000
    assert html_text.extract(tables, set()).count("z") == 40_000
    assert html_text.extract(text, set()) == ("word & " * 100_000).strip()
    assert time.time() - began < 60
    # A link around a block far above its text makes it a list of links.
    linked = "<div><a href=x>" + "<div>" * 20 + "Home and away" + "</div>" * 20 + "</a></div><div><p>The story of the day.</p></div>"
    assert html_text.extract(linked, set()) == "The story of the day."


def test_three_layouts_of_one_host_have_templates_each(spark):
    page = "<div class='{0}-page'><p class='{0}-note'>Notice of the {0}</p><div class='{0}-body'><p>Story {1} of today</p></div></div>"
    rows = [(i, "http://h.org/", page.format(("news", "blog", "shop")[i % 3], i)) for i in range(30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(df).collect()}
    assert got == {i: f"Story {i} of today" for i in range(30)}


def test_copies_of_one_url_do_not_fill_the_training_sample(spark):
    # A URL whose hash comes before those of all others, with more rows than the sample takes.
    hot = spark.range(20_000).select(F.concat(F.lit("http://x.org/"), "id").alias("u")).orderBy(F.xxhash64("u", F.lit(11))).first()["u"]
    rows = [(i, hot) for i in range(400)]
    rows += [(1000 + i, f"http://{'spam-spam-spam' if i % 2 else 'news'}{i}.example.{'com/de/' if i % 2 else 'org/x/'}{i}") for i in range(400)]
    rows += [(9000 + i, f"http://{'spam-spam-spam' if i % 2 else 'news'}{i}.example.{'com/x/' if i % 2 else 'org2/x/'}{i}") for i in range(40)]
    found = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), training_rows=300).filter("rule is null").collect()
    assert len({r["score"] for r in found}) > 1
    assert np.mean([(r["verdict"] == "block") == bool(r["page_id"] % 2) for r in found]) >= 0.9


def test_a_crowd_of_short_texts_is_numbered_in_several_parts(spark, monkeypatch):
    rows = [(i, "" if i % 3 else "long text " * 50 + str(i)) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    slim = df.select("doc_id", (F.length("text") + 1).cast("long").alias("size"), F.xxhash64("text", F.lit(1)).alias("h"), F.xxhash64("doc_id", F.lit(2)).alias("g"))
    edges, of = shards.parts_of(slim, 4)
    counts = [r["count"] for r in slim.groupBy(shards._part(edges)).count().collect()]
    assert max(counts) < 6000 / 4 / shards.FEWEST_PARTS * 2 and sorted(of) == of and set(of) == {0, 1, 2, 3}
    got = shards.shard(df, 4).select("shard", "slot").collect()
    for k in range(4):
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sum(r["shard"] == k for r in got)))


def test_replacement_characters_of_a_text_stay(spark):
    import string

    rng = random.Random(5)
    shared = "é" + "".join(rng.choice(string.ascii_letters) for _ in range(400)) + "é"
    own = [f"� first {i} " + "".join(rng.choice(string.ascii_letters) for _ in range(90)) for i in range(2)]
    # The second text has the shared passage between characters that share a byte with é.
    rows = [(0, own[0] + shared + " a"), (1, own[1] + "è" + shared[1:-1] + "ë �")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.cut_repeats(spark, df, FOLDER).collect()}
    assert got[0] == rows[0][1]
    assert len(got[1]) < len(rows[1][1]) - 300 and got[1].startswith("� first 1") and got[1].endswith(" �")
