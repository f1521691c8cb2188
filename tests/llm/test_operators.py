"""The operators against plain versions and the libraries, on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tilth.llm import context_tree, html_text, pfor, pieces, quality, queries, shards, simhash, suffixes, urls, winnow
from tilth.llm.graph import components
from tilth.llm.text import tokenizer_path

FOLDER = "/root/testdata/sf0.001"


def documents(spark, folder=FOLDER):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a long text, and columns whose names clash."""
    rng = random.Random(7)
    parts = ["abcdefghij" * 7, "é" * 30, "x" * 90, "zq ", "THE end. ", "\n", "a b c d e f g h i j k l m ", "[#*", "Lorem ipsum dolor sit amet consectetur adipiscing elit sed "]
    rows = [(rng.randrange(60), "".join(rng.choice(parts) for _ in range(rng.randrange(12)))) for _ in range(90)]
    rows += [(None, None), (None, "x y"), (3, None), (4, ""), (5, " \n\t"), rows[0], rows[0], (61, "word " * 3000), (62, "日本 " * 40 + "😀")]
    table = [(i, t, "src0", None, "clash", 1) for i, t in rows]
    return spark.createDataFrame(table, "doc_id long, text string, source string, decoded string, measures string, fingerprint int").repartition(5), rows


def same(got, want):
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("name", list(queries.CASES))
def test_query_gives_rows_and_survives_empty_tables(spark, tmp_path, name):
    query, _ = queries.CASES[name]
    rows = query(spark, FOLDER).count()
    # The trie has a row per node and collocations one per phrase; all others one per row of their table.
    table = {"op2_boosted_urls": "pages", "op3_html_templates": "pages", "op11_prefix_trie": None, "op13_collocations": None}.get(name, "documents")
    assert rows == spark.read.parquet(f"{FOLDER}/{table}.parquet").count() if table else rows > 0
    for t in ("documents", "pages", "benchmark", "conversations"):
        spark.read.parquet(f"{FOLDER}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert query(spark, str(tmp_path)).count() == 0


def test_simhash(spark, odd):
    for df, rows in (odd, (documents(spark), [tuple(r) for r in documents(spark).select("doc_id", "text").collect()])):
        prints = [brute.fingerprint(t) for _, t in rows]
        want = zip([i for i, _ in rows], (f"{p:016x}" for p in prints), brute.components([i for i, _ in rows], prints), strict=True)
        same([tuple(r) for r in simhash.digests(df).collect()], [tuple(w) for w in want])
    assert set(simhash.representatives(odd[0]).columns) == set(odd[0].columns)


def _edited(rng, words, changes):
    out = list(words)
    for k in rng.choice(len(out), changes, replace=False).tolist():
        out[k] = f"new{rng.integers(10**9)}"
    return out


def test_recall_of_similar_texts(spark):
    """Pairs of texts with words replaced, at each similarity of their five-word shingles from 0.8 on."""
    rng = np.random.default_rng(8)
    rows, pairs = [], []
    for trial in range(900):
        words = [f"w{x}" for x in rng.integers(0, 3000, rng.choice([80, 200, 500]))]
        other = _edited(rng, words, int(rng.integers(1, max(2, len(words) // 40))))
        rows += [(2 * trial, " ".join(words)), (2 * trial + 1, " ".join(other))]
        a, b = (brute.shingles(t, 5) for _, t in rows[-2:])
        pairs.append((len(a & b) / len(a | b), trial))
    found = {r["doc_id"]: r["component_id"] for r in simhash.similar_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[2 * t] == 2 * t for _, t in pairs)
    assert all(found[2 * t + 1] == 2 * t + 1 for s, t in pairs if s < 0.8)
    for low in (0.8, 0.85, 0.9, 0.95):
        caught = [found[2 * t + 1] == 2 * t for s, t in pairs if low <= s < low + 0.05]
        print(low, len(caught), np.mean(caught))
        assert len(caught) > 40 and np.mean(caught) >= 0.9


def test_similar_texts_of_awkward_rows(spark, odd):
    """No link that the sets do not bear out, and all of equal sets; of others a cell may miss a few (see the recall)."""
    df, rows = odd
    ids, sets = [i for i, _ in rows], [brute.shingles(t, 5) for _, t in rows]
    allowed = defaultdict(set)
    for i, d in zip(ids, brute.similar(ids, [t for _, t in rows]), strict=True):
        allowed[i].add(d)
    got = [(r["doc_id"], r["component_id"]) for r in simhash.similar_texts(df).collect()]
    assert sorted(i is None for i, _ in got) == sorted(i is None for i in ids) and len(got) == len(rows)
    within = {d: allowed[d] for _, d in got}
    assert all(d == i or within[d] & allowed[i] for i, d in got)
    for x in set(sets) - {frozenset()}:
        alike = {i for i, s in zip(ids, sets, strict=True) if s == x and ids.count(i) == 1}
        assert len({d for i, d in got if i in alike}) <= 1
    assert set(simhash.first_of_similar(df).columns) == set(df.columns)


def test_simhash_links_of_crowded_cells(spark):
    rng = np.random.default_rng(1)
    found = list(rng.integers(0, 2**63, 200, dtype=np.uint64))
    for base in found[:40]:
        for _ in range(30):
            x = int(base)
            for k in rng.integers(0, 64, rng.integers(0, 4)):
                x ^= 1 << int(k)
            found.append(np.uint64(x))
    prints = np.unique(np.array(found, np.uint64))
    ids = prints.view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in ids], "fingerprint long")
    root = {r["node"]: r["root"] for r in components(simhash.links(df)).collect()}
    assert [root.get(x, x) for x in ids] == brute.components(ids, prints)


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    root = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {root[i] for i in range(61)} == {0} and {root[1000 + i] for i in range(200)} == {1000}


def test_url_rules_and_verdicts(spark):
    given = [
        (1, None, "", "", None), (2, "foo", "", "", None), (3, "http://Example.ORG/es/x?y", "example.org", "/es/x", "example.org/es/"),
        (4, "http://a.example.org/en/12#q", "a.example.org", "/en/12", "example.org/en/1"), (5, "x://org", "org", "", None),
        (6, "http://org/", "org", "/", "org/"), (7, "a://b://c/d", "b:", "//c/d", None), (8, "http://xorg/", "xorg", "/", None),
        (9, "http://m.example.com/fr/1", "m.example.com", "/fr/1", "com/fr/"), (10, "http://com/de/", "com", "/de/", "com/de/"), (10, "http://com/de/", "com", "/de/", "com/de/"),
    ]
    pages = spark.createDataFrame([(i, u, "clash", 1.0) for i, u, *_ in given], "page_id long, url string, host string, score double")
    found = urls.judge(pages).collect()
    same([(r["page_id"], r["url"], r["host"], r["path"], r["rule"]) for r in found], given)
    for r in found:
        assert r["verdict"] in ("allow", "block") and (r["rule"] is None or r["verdict"] == urls.RULES[r["rule"]])
    one = urls.judge(pages.filter("page_id in (1, 6)")).collect()
    assert {r["verdict"] for r in one} == {"allow"}


def test_trees_learn_what_separates_urls(spark):
    rows = [(i, f"http://{'spam-spam-spam' if i % 2 else 'news'}{i}.example.{'com/de/' if i % 2 else 'org/a/'}{i}") for i in range(400)]
    rows += [(1000 + i, f"http://{'spam-spam-spam' if i % 2 else 'news'}{i}.example.{'com/x/' if i % 2 else 'net/x/'}{i}") for i in range(100)]
    found = urls.judge(spark.createDataFrame(rows, "page_id long, url string")).filter("rule is null").collect()
    assert np.mean([(r["verdict"] == "block") == bool(r["page_id"] % 2) for r in found]) >= 0.9


def test_main_text(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    got = {r["page_id"]: r for r in html_text.texts(pages).collect()}
    for r in pages.collect():
        want = brute.article(r["html"])
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def test_template_texts_go_and_slots_stay(spark):
    page = "<div class=top-line>{}</div><div><p>Our site since 1999</p><p>Story {} of today</p><ul><li><a href=x>Home</a></ul><section class='reader-comments'><p>me too</p></section></div>"
    rows = [(i, "http://h.org/", page.format("Hello", i)) for i in range(9)] + [(50, None, None), (51, "http://h.org/", ""), (52, "http://few.org/", page.format("A", "1 &lt; 2 &amp;"))]
    rows += [rows[0]]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = [(r["page_id"], r["text"]) for r in html_text.main_text(df).collect()]
    want = [(i, f"Story {i} of today") for i in range(9)] + [(0, "Story 0 of today"), (50, ""), (51, ""), (52, "Our site since 1999\n\nStory 1 < 2 & of today")]
    same(got, want)


def test_shards_are_even_and_gapless(spark, odd):
    crowd = [(i, "x" * 30 if i % 3 else f"t{i}") for i in range(3000)] + [(None, None), (None, ""), (7, None)]
    for df, rows in (odd, (spark.createDataFrame(crowd, "doc_id long, text string").repartition(4), crowd)):
        found = shards.shard(df).collect()
        same([(r["doc_id"], r["size"], r["text_crc32"]) for r in found], [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows])
        total, largest = sum(r["size"] for r in found), max(r["size"] for r in found)
        for k in range(8):
            own = [r for r in found if r["shard"] == k]
            assert sorted(r["slot"] for r in own) == list(range(len(own)))
            assert abs(sum(r["size"] for r in own) - total / 8) <= 0.01 * total / 8 + largest


def test_contamination(spark, odd):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice(["a", "b", "é", "C1", "the", "x"]) + rng.choice([" ", "-", "\n", "..."]) for _ in range(rng.randrange(n)))
    docs = [(i, text(60)) for i in range(200)] + odd[1]
    items = [(i, text(14)) for i in range(30)] + [(99, None), (98, "--"), (97, "THE the"), (96, "a b c d e f g h i j k l")]
    left, right = spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string")
    same([tuple(r) for r in winnow.digests(left, right).collect()], brute.contamination(docs, items))
    assert winnow.digests(left, right.limit(0)).filter("contaminated").count() == 0
    given = documents(spark), spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    want = brute.contamination(*([tuple(r)[:2] for r in t.collect()] for t in given))
    same([tuple(r) for r in winnow.digests(*given).collect()], want)


def test_packed_blocks_return_what_they_took():
    rng = np.random.default_rng(0)
    for n in (0, 1, 511, 512, 513, 5000):
        for high in (1, 2, 50_000, 2**32):
            values = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
            values[::37] = high - 1
            packed = pfor.pack(values)
            assert (pfor.unpack(packed) == values).all() and (pfor.unpack(packed, n // 3, n // 2) == values[n // 3 : n // 2]).all()


def test_token_ids(spark, odd, tmp_path):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer_path(pfor.WORDS))
    rng = random.Random(2)
    signs = [*" \t\n\r\x0b\x0c\x1c\x85\xa0AbÉé\u0301日😀1’Σςİ\u200btheing", "<|endoftext|>", "'ll", "***", "I'S", "x<|startoftext|>y", "<|EndOfText|>"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(3000)]
    flat, offsets = pfor.WordTable(tokenizer_path(pfor.WORDS), 1, size=500).encode(pa.array([*texts, None]))
    texts.append("")
    assert [flat[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [[*x.ids, 1] for x in model.encode_batch(texts, add_special_tokens=False)]
    df, rows = odd
    pfor.write_ids(df, f"{tmp_path}/ids", page=50)
    got = pfor.read_ids(spark, f"{tmp_path}/ids").orderBy("start").collect()
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]
    coded = [(i, np.array([*model.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for i, t in rows]
    same([(r["doc_id"], bytes(r["ids"])) for r in got], coded)


def test_pieces(spark, odd):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(pieces.MODEL))
    rng = random.Random(1)
    texts = ["".join(rng.choice(" ▁\n\t\r\x0b\x00ab’é日😀1<s>\u200b\u3000 theing'\u0301") for _ in range(rng.randrange(40))) for _ in range(3000)]
    table = pieces.ChunkTable(tokenizer_path(pieces.MODEL), size=500)
    flat, offsets, decoded = table.encode([*texts, "", " ", "</s>", "<0x0A>", "▁"])
    for text, a, b, back in zip([*texts, "", " ", "</s>", "<0x0A>", "▁"], offsets[:-1], offsets[1:], decoded, strict=True):
        want = [*model.encode(text), 2]
        assert flat[a:b].tolist() == want and back == model.decode(want)
    df, rows = odd
    out = pieces.decode(pieces.encode(df), out="again").collect()
    same([(r["doc_id"], r["piece_ids"], r["decoded"]) for r in out], [(i, x := [*model.encode(t or ""), 2], model.decode(x)) for i, t in rows])
    assert all(r["again"] == r["decoded"] for r in out)


def test_quality(spark, odd):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab \n\t\x0b#é\x1c\x85 ") for _ in range(rng.randrange(60))) for _ in range(500)]
    rows = [*odd[1], *enumerate(texts)]
    got = quality.verdicts(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    same([(r["doc_id"], *(r[n] for n in names)) for r in got], [(i, *brute.measures(t)) for i, t in rows])
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert set(quality.judge(odd[0]).columns) >= set(odd[0].columns)


def test_estimated_quality_agrees_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = quality.verdicts(documents(spark, folder)).join(labels, "doc_id").filter("not base_failed").collect()
    assert np.mean([r["kept"] for r in rows if r["quality"]]) >= 0.97
    assert np.mean([not r["kept"] for r in rows if not r["quality"]]) >= 0.9


def test_context_trees(spark, odd):
    rows = [(r["doc_id"], r["text"][:200]) for r in documents(spark).limit(15).collect()] + [(i, (t or "")[:150] if t is not None else None) for i, t in odd[1][-20:]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for depth in (3, 5):
        got = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in context_tree.score(df, depth=depth).collect()]
        key = lambda r: (repr(r[0]), r[2], r[6])
        for a, b in zip(sorted(got, key=key), sorted(brute.context_trees(rows, depth), key=key), strict=True):
            assert a[:5] == b[:5] and a[5] == pytest.approx(b[5]) and a[6] == pytest.approx(b[6], rel=1e-5)


def test_context_trees_beat_single_words_on_held_out_texts(spark):
    rows = context_tree.score(documents(spark, "/root/testdata/sf0.1")).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


def test_repeats(spark, odd):
    for df, rows in (odd, (documents(spark), [tuple(r) for r in documents(spark).select("doc_id", "text").collect()])):
        got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffixes.cut_repeats(df).collect()]
        same(got, brute.repeats(rows))


def test_suffix_array_of_few_signs():
    rng = random.Random(5)
    for _ in range(60):
        segments = [bytes(rng.choice(b"ab c") for _ in range(rng.randrange(50, 90))) if rng.random() < 0.5 else b"a" * rng.randrange(50, 80) for _ in range(rng.randrange(1, 12))]
        segments += [s[rng.randrange(5) :] for s in segments if len(s) > 60]
        docs, least = np.array([rng.randrange(6) for _ in segments]), {}
        starts, repeated = suffixes.common_windows(segments, docs)
        for s, d in zip(segments, docs, strict=True):
            for k in range(len(s) - 49):
                least[s[k : k + 50]] = min(least.get(s[k : k + 50], 99), d)
        for s, d, at in zip(segments, docs, starts, strict=True):
            assert [bool(x) for x in repeated[at : at + len(s) - 49]] == [least[s[k : k + 50]] < d for k in range(len(s) - 49)]


def test_pipeline_stages_against_plain_versions(spark):
    docs = documents(spark)
    columns = docs.columns
    kept = spark.createDataFrame(corpus_pipeline.keep_quality(spark, docs, FOLDER).collect(), docs.schema)
    good = {r["doc_id"] for r in quality.verdicts(docs).filter("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == good and kept.columns == columns
    rows = [(r["doc_id"], r["text"]) for r in kept.orderBy("doc_id").collect()]
    first = set(brute.similar([i for i, _ in rows], [t for _, t in rows]))
    single = spark.createDataFrame(corpus_pipeline.drop_near_copies(spark, kept, FOLDER).collect(), docs.schema)
    assert {r["doc_id"] for r in single.collect()} == first
    rows = [(r["doc_id"], r["text"]) for r in single.collect()]
    left = {i: b.decode("utf-8", "ignore") for i, _, _, _, b in brute.repeats(rows)}
    cut = spark.createDataFrame(corpus_pipeline.cut_repeats(spark, single, FOLDER).collect(), docs.schema)
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == {i: t for i, t in left.items() if t.strip()}
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect())
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    clean = {d for d, *_, hit in brute.contamination([(r["doc_id"], r["text"]) for r in cut.collect()], items) if not hit}
    final = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r["doc_id"] for r in final} == clean and all(r["decoded"] == r["text"] for r in final)


def test_pipeline_on_awkward_rows(spark, odd, tmp_path):
    docs = odd[0].withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, table, FOLDER)
            assert set(docs.columns) <= set(now.columns)
            now.count()
