"""Ranking and filtering of catalog candidates."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tilth.functions.scalars import auto_top_n, tokenize
from tilth.functions.store import cut
from tilth.functions.tokens import numbered_words, pieces

# Okapi BM25 parameters and the share of the mean idf given to very common terms.
K1 = 1.5
B = 0.75
EPSILON = 0.25
# Fixed value: bonus per query that found a candidate.
MATCH_BONUS = 0.05
# Bytes of texts, or counts of query terms, that a Python worker looks at together; words that wait there to be added up.
PIECE, WAITING = 1 << 21, 1 << 18
# Distinct terms that the queries may hold: they go to every task (some tens of megabytes).
MAX_QUERY_TERMS = 1_000_000


def query_terms(texts: DataFrame, text_col: str) -> DataFrame:
    """Query terms with their multiplicity over all query texts."""
    return (
        texts.select(F.explode(tokenize(text_col)).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("repeats"))
    )


def terms_of(spark, queries: Sequence[str], keywords: Sequence[str] = ()) -> DataFrame:
    """Query terms of given phrases."""
    text = F.lit(" ".join([*queries, *keywords]))
    return query_terms(spark.range(1).select(text.alias("t")), "t")


def _added_up(counts: list[pa.Table]) -> pa.Table:
    """One row per term."""
    found = pa.concat_tables(counts).group_by("term").aggregate([("df", "sum")])
    return found.select(["term", "df_sum"]).rename_columns(["term", "df"])


def _vocabulary_rows(found: pa.Table, known: pa.Schema) -> Iterator[pa.RecordBatch]:
    for part in found.combine_chunks().to_batches():
        nothing = [pa.nulls(len(part), kind) for kind in known.types[:-2]]
        yield pa.RecordBatch.from_arrays([*nothing, part.column("term"), part.column("df")], schema=known)


def _counted(batches: Iterator[pa.RecordBatch], fields: T.StructType, asked_terms: pa.Array) -> Iterator[pa.RecordBatch]:
    """Rows of documents (their columns, length, and counts of query terms) and rows of the vocabulary."""
    known, kept = to_arrow_schema(fields), fields.fields[:-5]
    waiting: list[pa.Table] = []
    for whole in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(whole.column("text")), 0), np.int64)
        for a, b in pieces(sizes, PIECE):
            batch = whole.slice(a, b - a)
            n = batch.num_rows
            of, number, distinct = numbered_words(batch.column("text"))
            # Each pair of document and word once, in order of documents.
            pairs, counts = np.unique(of * max(len(distinct), 1) + number, return_counts=True)
            document, word = np.divmod(pairs, max(len(distinct), 1))
            distinct = distinct.cast(pa.string())
            asked_at = pc.fill_null(pc.index_in(distinct, value_set=asked_terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)[word]
            hit = asked_at >= 0
            offsets = pa.array(np.searchsorted(document[hit], np.arange(n + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x[hit].astype(np.int32))) for x in (asked_at, counts)]
            own = [batch.column(f.name).cast(known.field(f.name).type) for f in kept]
            yield pa.RecordBatch.from_arrays([*own, pa.array(np.bincount(of, minlength=n)), *lists, pa.nulls(n, pa.string()), pa.nulls(n, pa.int64())], schema=known)
            waiting.append(pa.table([distinct, pa.array(np.bincount(word, minlength=len(distinct)))], names=["term", "df"]))
            if sum(map(len, waiting)) > WAITING:
                waiting = [_added_up(waiting)]
                if len(waiting[0]) > WAITING // 2:
                    yield from _vocabulary_rows(waiting.pop(), known)
    if waiting:
        yield from _vocabulary_rows(_added_up(waiting), known)


def bm25(
    docs: DataFrame, terms: DataFrame, id_col: str = "id", text_col: str = "corpus_text", carry: Sequence[str] = ()
) -> DataFrame:
    """(id, score) of every document for a multiset of query terms; ``carry`` columns stay beside them.

    One scan counts words inside documents: what leaves it is one count per word of the
    vocabulary of some hundred thousand words, and of each document its length and the counts of
    query terms.  A task looks at a few documents at a time, whatever the size of its batches.  A term in more than half of the documents has a negative idf, which is
    replaced by a quarter of the mean idf over the vocabulary.  Null texts are empty.
    """
    asked = terms.groupBy("term").agg(F.sum("repeats").alias("repeats")).orderBy("term").limit(MAX_QUERY_TERMS + 1).collect()
    if len(asked) > MAX_QUERY_TERMS:
        raise ValueError(f"the queries hold more than {MAX_QUERY_TERMS} distinct terms")
    place = {r["term"]: i for i, r in enumerate(asked)}
    asked_terms = pa.array(list(place), pa.string())
    # Lower-casing is Spark's, by Unicode; words are bytes of ASCII after it.
    given = docs.select(F.col(id_col).alias("id"), F.lower(text_col).alias("text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])
    kept = [f for f in given.schema.fields if f.name != "text"]
    fields = T.StructType([
        *[T.StructField(f.name, f.dataType) for f in kept], T.StructField("words", T.LongType()), T.StructField("at", T.ArrayType(T.IntegerType())),
        T.StructField("tf", T.ArrayType(T.IntegerType())), T.StructField("term", T.StringType()), T.StructField("df", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _counted(batches, fields, asked_terms)

    counted = cut(given.mapInArrow(run, fields))
    found = counted.filter("words is not null")
    totals = found.agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("words")).first()
    n = float(totals["n"])
    average = (totals["words"] or 0) / n if n else 1.0
    idf = F.log(F.lit(n) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    vocabulary = counted.filter("term is not null").groupBy("term").agg(F.sum("df").cast("double").alias("df")).withColumn("idf", idf)
    named = F.broadcast(terms.sparkSession.createDataFrame([(r["term"],) for r in asked], "asked string"))
    # The mean of all terms and the idf of those asked for, from one pass over the vocabulary.
    picked = vocabulary.join(named, F.col("term") == F.col("asked"), "left").agg(
        F.avg("idf").alias("mean"), F.collect_list(F.when(F.col("asked").isNotNull(), F.struct("term", "idf"))).alias("asked")
    ).first()
    weights = np.zeros(len(asked))
    for r in picked["asked"]:
        i = place[r["term"]]
        weights[i] = asked[i]["repeats"] * (r["idf"] if r["idf"] >= 0 else EPSILON * picked["mean"])
    names = [f.name for f in kept]
    scored = T.StructType([*[T.StructField(f.name, f.dataType) for f in kept], T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in pieces(np.diff(np.asarray(whole.column("tf").offsets)), PIECE // 8):
                batch = whole.slice(a, b - a)
                lists = batch.column("tf")
                of = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)))
                tf, at = np.asarray(lists.flatten(), float), np.asarray(batch.column("at").flatten(), np.int64)
                length = 1 - B + B * np.asarray(batch.column("words"), float)[of] / average if average else np.ones(len(of))
                gain = weights[at] * tf * (K1 + 1) / (tf + K1 * length)
                yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(np.bincount(of, gain, batch.num_rows).astype(float))], names=scored.names)

    out = found.select(*names, "words", "at", "tf").mapInArrow(score, scored)
    return out.select(F.col("id").alias(id_col), *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], "score")


def bm25_boosted(docs: DataFrame, terms: DataFrame, id_col: str = "id", text_col: str = "corpus_text",
                 match_col: str = "query_match_count") -> DataFrame:
    """BM25 plus a small bonus per matching query; an absent count is one query."""
    if match_col not in docs.columns:
        docs = docs.withColumn(match_col, F.lit(1))
    scores = bm25(docs, terms, id_col, text_col, [match_col])
    return scores.select(id_col, (F.col("score") + MATCH_BONUS * F.coalesce(F.col(match_col), F.lit(1))).alias("score"))


def top_n(df: DataFrame, score: str, n: int, id_col: str = "id") -> DataFrame:
    """The ``n`` highest scores, ties by id; a partial top-n per task comes before the merge."""
    return df.orderBy(F.desc(score), id_col).limit(n)


def bm25_top(docs: DataFrame, terms: DataFrame, n: int, id_col: str = "id",
             text_col: str = "corpus_text") -> DataFrame:
    """The ``n`` best candidates with their attributes and ``score``."""
    best = top_n(bm25_boosted(docs, terms, id_col, text_col), "score", n, id_col)
    return docs.join(best, id_col).orderBy(F.desc("score"), id_col)


def choose_top_n(catalog: DataFrame) -> DataFrame:
    """One row: number of candidates and how many of them to rank."""
    return catalog.agg(F.count(F.lit(1)).alias("candidates")).select(
        "candidates", auto_top_n(F.col("candidates")).cast("long").alias("top_n")
    )


def catalog_filter(
    catalog: DataFrame,
    *,
    task: str | None = None,
    license: str | None = None,
    file_type: str | None = None,
    tags: Sequence[str] = (),
) -> DataFrame:
    """Optional filters on the catalog; a blank one does not filter."""
    cond: Column = F.lit(True)
    if task:
        cond = cond & F.array_contains("task_categories", task)
    if license:
        cond = cond & (F.col("license") == license)
    if file_type:
        cond = cond & F.array_contains("tags", file_type)
    for tag in tags:
        if tag:
            cond = cond & F.array_contains("tags", tag)
    return catalog.filter(cond)


# Sort orders of a catalog listing.
SORT_COLUMNS = {
    "hottest": "downloads",
    "votes": "likes",
    "updated": "last_updated",
    "active": "last_updated",
}


def catalog_sort(catalog: DataFrame, by: str = "hottest", id_col: str = "id") -> DataFrame:
    return catalog.orderBy(F.desc(SORT_COLUMNS[by]), id_col)
