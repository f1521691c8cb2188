"""Text classification with MLlib and active learning."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    ElementwiseProduct,
    IndexToString,
    NGram,
    Normalizer,
    RegexTokenizer,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.functions.hashing import stable_hash
from tilth.functions.store import brief_shuffles, cut, drop, small_batches
from tilth.functions.tokens import pieces
from tilth.operators.agree import evaluate
from tilth.operators.combine import history_compare
from tilth.operators.sampling import sample_n

# Vocabulary size and token pattern of the text features.
MAX_TERMS = 10_000
TOKEN = r"(?U)\b\w\w+\b"
# Rows per task while fitting.
TRAIN_ROWS = 5_000
# An SVM stops where a step changes its loss by no more than this share.
SVM_TOLERANCE = 1e-4
# Random features that stand for the kernel of the SVM, and folds whose margins it is calibrated on.
KERNEL_FEATURES = 512
CALIBRATION_FOLDS = 3
# Terms, vector entries or features that a Python worker holds as numbers at a time.
PIECE = 1 << 18
HISTORY = "iteration int, n_labeled long, accuracy double, f1 double, strategy string"


def _lists(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


def _vector_array(size: int | None, indices: pa.Array, values: pa.Array) -> pa.StructArray:
    """Vectors as Arrow holds them: sparse ones of ``size`` numbers, or dense ones."""
    n = len(values)
    kind, width = pa.array(np.full(n, size is None, np.int8)), pa.nulls(n, pa.int32()) if size is None else pa.array(np.full(n, size, np.int32))
    return pa.StructArray.from_arrays([kind, width, indices, values], names=["type", "size", "indices", "values"])


@F.arrow_udf(VectorUDT())
def _sublinear(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """1 + ln(tf) on the stored entries of count vectors."""
    for whole in batches:
        for a, b in pieces(np.diff(np.asarray(whole.field("values").offsets)), PIECE):
            yield _logs(whole.slice(a, b - a))
        # It would else be held until the next one is there.
        del whole


def _logs(counts: pa.StructArray) -> pa.StructArray:
    kind, size, indices, values = counts.flatten()
    logs = pa.ListArray.from_arrays(_offsets(values), pa.array(1.0 + np.log(np.asarray(values.flatten()))))
    return pa.StructArray.from_arrays([kind, size, indices, logs], names=["type", "size", "indices", "values"])


def _offsets(lists: pa.ListArray) -> pa.Array:
    """Where lists begin and end among their flattened entries."""
    at = np.asarray(lists.offsets)
    return pa.array(at - at[0], pa.int32())


def _tokenizer() -> RegexTokenizer:
    return RegexTokenizer(inputCol="_text", outputCol="_words", pattern=TOKEN, gaps=False)


def _words() -> PipelineModel:
    """Text to terms, without state."""
    return PipelineModel(
        stages=[
            _tokenizer(),
            NGram(n=2, inputCol="_words", outputCol="_pairs"),
            SQLTransformer(statement="SELECT *, concat(_words, _pairs) AS _terms FROM __THIS__"),
        ]
    )


def count_terms(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` without its text but with ``_counts``: its distinct terms and how often each occurs.

    Terms are words and pairs of neighbouring words; only words go to Python.
    Written once, this serves vocabularies, fits and scores of any rows without the text.
    """
    fields = [f for f in df.schema.fields if f.name != text_col]
    names = [f.name for f in fields]
    words = _tokenizer().transform(df.withColumn("_text", F.coalesce(text_col, F.lit("")))).select(*names, F.col("_words").alias("_terms"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _counted(batches, names, pairs=True)

    schema = T.StructType([*fields, T.StructField("_counts", T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("n", T.IntegerType())])))])
    return words.mapInArrow(run, schema)


def _counted(batches: Iterator[pa.RecordBatch], names: list[str], pairs: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows with the columns ``names`` and the counts of their ``_terms``, with ``pairs`` also of neighbours among them."""
    for whole in batches:
        # Terms stay Arrow strings, and a few of them at a time: a batch may hold millions.
        for a, b in pieces(np.diff(np.asarray(whole.column("_terms").offsets)), PIECE):
            yield _count(whole.slice(a, b - a), names, pairs)
        del whole


def _count(batch: pa.RecordBatch, names: list[str], pairs: bool) -> pa.RecordBatch:
    lists = batch.column("_terms")
    of = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
    words = lists.flatten().dictionary_encode()
    terms, at = words.dictionary, np.asarray(words.indices, np.int64)
    if pairs:
        first, second, near, which = _neighbours(of, at, len(terms))
        of, at = np.concatenate([of, of[near]]), np.concatenate([at, len(terms) + which])
        terms = pa.concat_arrays([terms, pc.binary_join_element_wise(terms.take(first), terms.take(second), " ")])
    distinct = max(len(terms), 1)
    found, counts = np.unique(of * distinct + at, return_counts=True)
    row, term = np.divmod(found, distinct)
    entries = pa.StructArray.from_arrays([terms.take(pa.array(term)), pa.array(counts.astype(np.int32))], names=["term", "n"])
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), _lists(np.bincount(row, minlength=len(lists)), entries)], names=[*names, "_counts"])


def _neighbours(of: np.ndarray, at: np.ndarray, distinct: int) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
    """The distinct pairs of neighbouring words of a row: both words, where pairs begin, and which of the distinct ones each is."""
    near = np.flatnonzero(of[1:] == of[:-1])
    found = pa.array(at[near] * distinct + at[near + 1]).dictionary_encode()
    first, second = np.divmod(np.asarray(found.dictionary), max(distinct, 1))
    return pa.array(first), pa.array(second), near, np.asarray(found.indices, np.int64)


def _vectors(vocabulary: list[str]):
    """Column function: term counts to sparse vectors of 1 + ln(tf)."""

    @F.arrow_udf(VectorUDT())
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = pa.array(vocabulary, pa.string())
        for whole in batches:
            for a, b in pieces(np.diff(np.asarray(whole.offsets)), PIECE):
                yield _placed(whole.slice(a, b - a), known)
            del whole

    return vectors


def _placed(lists: pa.ListArray, known: pa.Array) -> pa.StructArray:
    term, n = lists.flatten().flatten()
    place = pc.fill_null(pc.index_in(term, value_set=known), -1).to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
    kept = np.flatnonzero(place >= 0)
    return _sublinear_vectors(len(known), len(lists), of[kept], place[kept], np.asarray(n)[kept])


def pack_terms(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` and its counts of terms as ``_counts``, for scores round after round: a term is the 64-bit key of
    ``_keys``, and terms and counts of a row are a run of bytes each. Strings are made of words only.
    """
    names = df.columns
    words = _tokenizer().transform(df.withColumn("_text", F.coalesce(text_col, F.lit("")))).select(*names, F.col("_words").alias("_terms"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in pieces(np.diff(np.asarray(whole.column("_terms").offsets)), PIECE):
                batch = whole.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), _pack(batch.column("_terms"))], names=[*names, "_counts"])
                del batch
            del whole

    packed = T.StructType([T.StructField("terms", T.BinaryType()), T.StructField("n", T.BinaryType())])
    return words.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("_counts", packed)]))


def _keys(words: list[str]) -> np.ndarray:
    return hash_array(np.array(words, object), categorize=False)


def _pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Keys of pairs from those of their words, spread by the last steps of MurmurHash3."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + (second ^ (second >> np.uint64(29)))
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def _pack(lists: pa.ListArray) -> pa.StructArray:
    """Lists of words to the sorted keys of their terms and the counts of these."""
    of = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
    words = lists.flatten().dictionary_encode()
    at, keys = np.asarray(words.indices, np.int64), _keys(words.dictionary.to_pylist())
    first, second, near, which = _neighbours(of, at, len(keys))
    of, at = np.concatenate([of, of[near]]), np.concatenate([at, len(keys) + which])
    keys = np.concatenate([keys, _pair_keys(keys[np.asarray(first)], keys[np.asarray(second)])])
    distinct, place = np.unique(keys, return_inverse=True)
    found, counts = np.unique(of * max(len(distinct), 1) + place[at], return_counts=True)
    row, term = np.divmod(found, max(len(distinct), 1))
    sizes = np.bincount(row, minlength=len(lists))
    return pa.StructArray.from_arrays([_bytes(sizes, distinct[term]), _bytes(sizes, counts.astype(np.uint32))], names=["terms", "n"])


def _bytes(sizes: np.ndarray, values: np.ndarray) -> pa.Array:
    """Rows of ``sizes`` numbers as bytes."""
    offsets = (np.concatenate([[0], np.cumsum(sizes)]) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _numbers(rows: pa.Array, kind: type) -> np.ndarray:
    """The numbers of all rows of ``_bytes``."""
    whole = rows.cast(pa.large_binary())
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    return np.frombuffer(whole.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(kind) if offsets[-1] > offsets[0] else np.zeros(0, kind)


def _packed_vectors(vocabulary: list[str]):
    """Column function: counts of ``pack_terms`` to sparse vectors of 1 + ln(tf)."""
    size = len(vocabulary)

    @F.arrow_udf(VectorUDT())
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _Known(vocabulary)
        for whole in batches:
            sizes = np.asarray(pc.binary_length(whole.flatten()[0]), np.int64) // 8
            for a, b in pieces(sizes, PIECE):
                terms, n = whole.slice(a, b - a).flatten()
                at, place = known.find(_numbers(terms, np.uint64))
                yield _sublinear_vectors(size, b - a, np.repeat(np.arange(b - a), sizes[a:b])[at], place, _numbers(n, np.uint32)[at])
                del terms, n
            del whole

    return vectors


class _Known:
    """Places of a vocabulary's terms by their keys."""

    def __init__(self, vocabulary: list[str]):
        words = [t.partition(" ") for t in vocabulary]
        keys = _keys([w[0] for w in words])
        pair = np.array([bool(w[1]) for w in words], bool)
        keys[pair] = _pair_keys(keys[pair], _keys([w[2] for w in words if w[1]]))
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        # Most other terms are told by the first bits of their keys.
        self.shift = np.uint64(64 - 20)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.keys >> self.shift] = True

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``keys`` are of known terms, and where these stand in the vocabulary."""
        at = np.flatnonzero(self.maybe[keys >> self.shift])
        found = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
        hit = self.keys[found] == keys[at]
        return at[hit], self.order[found[hit]]


def _sublinear_vectors(size: int, rows: int, of: np.ndarray, place: np.ndarray, n: np.ndarray) -> pa.StructArray:
    """Sparse vectors of 1 + ln(n), from row, place and count of their entries."""
    order = np.argsort(of * size + place)
    counts = np.bincount(of, minlength=rows)
    values = 1.0 + np.log(n[order].astype(float))
    return _vector_array(size, _lists(counts, pa.array(place[order].astype(np.int32))), _lists(counts, pa.array(values)))


@dataclass(frozen=True)
class Kernel:
    """Random Fourier features of the kernel exp(-gamma |x - y|^2): their products approximate it
    (Rahimi and Recht, "Random features for large-scale kernel machines", 2007)."""

    gamma: float
    terms: int
    features: int = KERNEL_FEATURES
    seed: int = 42


@lru_cache(maxsize=2)
def _directions(kernel: Kernel) -> tuple[np.ndarray, np.ndarray]:
    """The random directions and phases, drawn anew by each worker from the seed: nothing is shipped."""
    rng = np.random.default_rng(kernel.seed)
    return rng.normal(0.0, math.sqrt(2 * kernel.gamma), (kernel.terms, kernel.features)), rng.uniform(0.0, 2 * math.pi, kernel.features)


def _fourier(kernel: Kernel):
    """Column function: sparse vectors to the kernel's dense features."""

    @F.arrow_udf(VectorUDT())
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        along, phase = _directions(kernel)
        for whole in batches:
            for at in range(0, len(whole), PIECE // kernel.features):
                # The given vectors may be dense: those have no indices.
                _, _, indices, values = whole.slice(at, PIECE // kernel.features).flatten()
                sums = np.empty((len(values), kernel.features))
                for row, (i, v) in enumerate(zip(indices, values, strict=True)):
                    x = np.asarray(v.values, float)
                    sums[row] = x @ along[np.asarray(i.values)] if i.is_valid else x @ along
                waves = pa.array((np.cos(sums + phase) * math.sqrt(2 / kernel.features)).ravel())
                yield _vector_array(None, pa.nulls(len(values), pa.list_(pa.int32())), _lists(np.full(len(values), kernel.features), waves))

    return features


@dataclass
class TextClassifier:
    """Fitted TF-IDF features and classifier; columns added: prediction label and probability array."""

    counts: PipelineModel
    weights: PipelineModel
    classifier: PipelineModel
    labels: list[str] = field(default_factory=list)
    kernel: Kernel | None = None

    def _weighted(self, df: DataFrame) -> DataFrame:
        """Features from sublinear counts ``_tf``."""
        weighted = self.weights.transform(df)
        return weighted if self.kernel is None else weighted.withColumn("_features", _fourier(self.kernel)("_features"))

    def features(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        counted = self.counts.transform(df.withColumn("_text", F.coalesce(text_col, F.lit(""))))
        weighted = self._weighted(counted.withColumn("_tf", _sublinear("_counts")))
        return weighted.drop("_text", "_words", "_pairs", "_terms", "_counts", "_tf", "_idf")

    def _scored(self, features: DataFrame, columns: list[str]) -> DataFrame:
        scored = self.classifier.transform(features)
        return scored.select(*columns, F.col("_predicted").alias("predicted"), vector_to_array("_probability").alias("probability"))

    def transform(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        return self._scored(self.features(df, text_col), df.columns)

    def transform_counted(self, counted: DataFrame) -> DataFrame:
        """As ``transform``, for rows of ``count_terms`` or ``pack_terms``; the counts are left out."""
        packed = isinstance(counted.schema["_counts"].dataType, T.StructType)
        vectors = (_packed_vectors if packed else _vectors)(self.counts.stages[-1].vocabulary)
        return self._scored(self._weighted(counted.withColumn("_tf", vectors("_counts"))), [c for c in counted.columns if c != "_counts"])

    def save(self, path: str) -> None:
        self.counts.write().overwrite().save(f"{path}/counts")
        self.weights.write().overwrite().save(f"{path}/weights")
        self.classifier.write().overwrite().save(f"{path}/classifier")
        spark = SparkSession.active()
        known = json.dumps({"labels": self.labels, "kernel": None if self.kernel is None else asdict(self.kernel)})
        spark.createDataFrame([(known,)], "known string").write.mode("overwrite").text(f"{path}/labels")

    @staticmethod
    def load(path: str) -> TextClassifier:
        known = json.loads(SparkSession.active().read.text(f"{path}/labels").first()[0])
        return TextClassifier(
            PipelineModel.load(f"{path}/counts"),
            PipelineModel.load(f"{path}/weights"),
            PipelineModel.load(f"{path}/classifier"),
            known["labels"],
            None if known["kernel"] is None else Kernel(**known["kernel"]),
        )


def fit_text_classifier(
    df: DataFrame,
    *,
    text_col: str = "text",
    label_col: str = "label",
    model: str = "logreg",
    max_terms: int = MAX_TERMS,
    max_iter: int = 1000,
) -> TextClassifier:
    """TF-IDF over words and word pairs with a classifier.

    Features follow sublinear tf, smoothed idf plus one, unit length.  ``logreg`` is
    L2-regularised with weight 1/n on the mean loss.  ``svm`` is a support vector machine
    per class with a Gaussian kernel, whose width is the inverse of the number of terms
    times the features' variance; the kernel is that of ``KERNEL_FEATURES`` random
    Fourier features.  ``linear_svm`` has none.  Margins of both become probabilities by
    logistic regression on rows that the machine was not fitted on, in ``CALIBRATION_FOLDS``
    folds; the table with the folds is written before it is used.
    All stop by tolerance; ``max_iter`` only bounds the steps of a fit that never gets there.
    """
    data = df.filter(F.col(label_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("_label"))
    with small_batches(df.sparkSession):
        counted = cut(count_terms(data))
    try:
        return fit_counted(counted, model=model, max_terms=max_terms, max_iter=max_iter)
    finally:
        drop(counted)


def fit_counted(
    counted: DataFrame, *, label_col: str = "_label", model: str = "logreg", max_terms: int = MAX_TERMS, max_iter: int = 1000
) -> TextClassifier:
    """As ``fit_text_classifier``, for rows of ``count_terms``."""
    if model not in ("logreg", "svm", "linear_svm"):
        raise ValueError("model must be logreg, svm or linear_svm")
    data = counted.filter(F.col(label_col).isNotNull()).select("_counts", F.col(label_col).cast("string").alias("_label"))
    # The most frequent terms by partial counts, ties by term; at most ``max_terms`` reach the driver.
    with brief_shuffles(data.sparkSession):
        frequent = (
            data.select(F.explode("_counts").alias("c"))
            .groupBy("c.term")
            .agg(F.sum("c.n").alias("n"))
            .orderBy(F.desc("n"), "term")
            .limit(max_terms)
        )
        vocabulary = [r["term"] for r in frequent.collect()]
    if not vocabulary:
        raise ValueError("the training texts hold no words")
    counter = PipelineModel(
        stages=[
            *_words().stages,
            CountVectorizerModel.from_vocabulary(vocabulary, inputCol="_terms", outputCol="_counts"),
        ]
    )
    index = StringIndexer(inputCol="_label", outputCol="_y", stringOrderType="alphabetAsc").fit(data)
    if len(index.labels) < 2:
        raise ValueError(f"the training rows hold a single class: {index.labels}")
    fold = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(CALIBRATION_FOLDS)).alias("_fold")
    with small_batches(data.sparkSession):
        tf = cut(index.transform(data).select(_vectors(vocabulary)("_counts").alias("_tf"), "_y", fold))
    idf = IDF(inputCol="_tf", outputCol="_idf").fit(tf).idf.toArray() + 1.0
    weights = Pipeline(
        stages=[
            ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_tf", outputCol="_idf"),
            Normalizer(p=2.0, inputCol="_idf", outputCol="_features"),
        ]
    ).fit(tf)
    n = tf.count()
    # The optimiser runs one job per step: few tasks while the rows are few.
    parts = -(-n // TRAIN_ROWS)
    train = weights.transform(tf).select("_features", "_y", "_fold")
    kernel = None
    if model == "svm":
        kernel = Kernel(_gamma(train, n, len(vocabulary)), len(vocabulary))
        with small_batches(data.sparkSession):
            train = cut(train.withColumn("_features", _fourier(kernel)("_features")))
    train = train.coalesce(max(parts, 1))
    # A fit reads its rows twice and keeps them in blocks of its own: only many fits gain by a cache before those.
    if model != "logreg":
        train.persist()
    try:
        decode = IndexToString(inputCol="_prediction", outputCol="_predicted", labels=index.labels)
        logreg = LogisticRegression(
            featuresCol="_features", labelCol="_y", predictionCol="_prediction",
            probabilityCol="_probability", rawPredictionCol="_raw",
            regParam=1.0 / n, standardization=False, maxIter=max_iter,
        )
        if model == "logreg":
            stages = [logreg.fit(train)]
        else:
            classes = len(index.labels)
            stages = _one_vs_rest(train, classes, n, max_iter)
            unseen = [
                PipelineModel(stages=_one_vs_rest(train.filter(F.col("_fold") != f), classes, n, max_iter)).transform(train.filter(F.col("_fold") == f)).select("_margins", "_y")
                for f in range(CALIBRATION_FOLDS)
            ]
            margins = cut(reduce(DataFrame.unionByName, unseen))
            stages.append(logreg.copy({logreg.featuresCol: "_margins"}).fit(margins))
        classifier = PipelineModel(stages=[*stages, decode])
    finally:
        train.unpersist()
        drop(tf)
    return TextClassifier(counter, weights, classifier, list(index.labels), kernel)


def _gamma(train: DataFrame, n: int, terms: int) -> float:
    """One over the number of terms times the variance of all entries of the features."""
    x = vector_to_array("_features")
    sums = train.select(
        F.aggregate(x, F.lit(0.0), lambda a, v: a + v).alias("s"), F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v).alias("q")
    ).agg(F.sum("s").alias("s"), F.sum("q").alias("q")).first()
    variance = sums["q"] / (n * terms) - (sums["s"] / (n * terms)) ** 2
    return 1.0 / (terms * variance) if variance > 0 else 1.0


def _one_vs_rest(train: DataFrame, classes: int, n: int, max_iter: int) -> list:
    """One linear SVM per class (one in all for two classes) and their margins as a vector."""
    wanted = range(classes) if classes > 2 else [1]
    stages: list = [
        LinearSVC(
            featuresCol="_features", labelCol="_is", predictionCol=f"_vote_{i}", rawPredictionCol=f"_margin_{i}",
            regParam=1.0 / n, standardization=False, maxIter=max_iter, tol=SVM_TOLERANCE,
        ).fit(train.withColumn("_is", (F.col("_y") == i).cast("double")))
        for i in wanted
    ]
    stages.append(VectorAssembler(inputCols=[f"_margin_{i}" for i in wanted], outputCol="_margins"))
    return stages


def entropy_score(probability: Column | str) -> Column:
    """Shannon entropy of a probability array; higher is less certain."""
    p = F.col(probability) if isinstance(probability, str) else probability
    return -F.aggregate(
        F.transform(p, lambda x: x * F.log(x + 1e-10)), F.lit(0.0), lambda acc, x: acc + x
    )


def margin_score(probability: Column | str) -> Column:
    """Negative gap between the two largest probabilities; higher is less certain."""
    p = F.sort_array(probability, asc=False)
    return -(p[0] - p[1])


def query(
    pool: DataFrame,
    strategy: str,
    batch: int,
    id_col: str,
    *,
    probability_col: str = "probability",
    seed: object = 42,
) -> DataFrame:
    """The ``batch`` most informative pool rows; ties by id.  ``random`` draws by seed."""
    if strategy == "random":
        return sample_n(pool, batch, id_col, seed)
    if strategy not in ("entropy", "margin"):
        raise ValueError("strategy must be entropy, margin or random")
    score = entropy_score(probability_col) if strategy == "entropy" else margin_score(probability_col)
    return pool.orderBy(score.desc(), id_col).limit(batch)


def run_cycle(
    seed_rows: DataFrame,
    pool: DataFrame,
    id_col: str,
    *,
    strategy: str = "entropy",
    n_iterations: int = 5,
    batch: int = 20,
    test: DataFrame | None = None,
    text_col: str = "text",
    label_col: str = "label",
    model: str = "logreg",
    seed: int = 42,
    max_terms: int = MAX_TERMS,
) -> tuple[DataFrame, TextClassifier]:
    """Fit, evaluate, query, move rows; one history row per evaluation.

    Texts are written once with their terms counted and packed, which every round scores.
    Labelled rows are the seed and those whose ids were drawn, at most ``batch`` a round:
    the terms of new ones are counted from their texts and kept.
    """
    spark = seed_rows.sparkSession

    def packed(df: DataFrame, seeded: bool) -> DataFrame:
        return pack_terms(df.select(id_col, F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("_label"), F.lit(seeded).alias("_seeded")))

    def kept(rows: DataFrame) -> DataFrame:
        # They lie in as many tasks as the pool: a few, by id, do for the many small jobs of a fit.
        return count_terms(rows.select(id_col, "text", "_label").repartition(id_col)).persist()

    with small_batches(spark):
        every = cut(packed(seed_rows, True).unionByName(packed(pool, False)))
        held_out = None if test is None else cut(packed(test, False).drop("text"))
        rest = every.filter("not _seeded")
        parts = [kept(every.filter("_seeded"))]
        history, fitted = [], None
        try:
            for iteration in range(n_iterations + 1):
                labelled = reduce(DataFrame.unionByName, parts)
                fitted = fit_counted(labelled, model=model, max_terms=max_terms)
                scored = fitted.transform_counted(labelled if held_out is None else held_out)
                m = evaluate(scored, "_label", "predicted", labelled.select("_label").distinct()).first()
                history.append((iteration, labelled.count(), m["accuracy"], m["f1"], strategy))
                if iteration == n_iterations:
                    break
                candidates = rest if strategy == "random" else fitted.transform_counted(rest.drop("text"))
                fresh = cut(query(candidates, strategy, batch, id_col, seed=f"{seed}-{iteration}").select(id_col))
                if fresh.isEmpty():
                    break
                parts.append(kept(rest.join(fresh, id_col, "left_semi")))
                rest = rest.join(fresh, id_col, "left_anti")
        finally:
            for part in parts:
                part.unpersist()
            for table in (every, held_out):
                if table is not None:
                    drop(table)
    return spark.createDataFrame(history, HISTORY), fitted


def savings(history: DataFrame, baseline: DataFrame, metric: str = "f1") -> DataFrame:
    """One row: where ``history`` first reaches the final quality of ``baseline``, and labels saved."""
    final = baseline.agg(
        F.max_by(F.struct(F.col(metric).alias("q"), F.col("n_labeled").alias("n")), "iteration")
    ).scalar()
    reached = history.agg(
        F.min_by(
            F.when(F.col(metric) >= final["q"], F.col("n_labeled")),
            F.when(F.col(metric) >= final["q"], F.col("iteration")),
        ).alias("n")
    )
    saved = F.col("random_final_n_labeled") - F.col("entropy_reached_same_quality_at_n")
    return (
        reached.select(
            F.lit(metric).alias("target_metric"),
            final["q"].alias("random_final_quality"),
            final["n"].alias("random_final_n_labeled"),
            F.col("n").alias("entropy_reached_same_quality_at_n"),
        )
        .withColumn("labels_saved", saved)
        .withColumn(
            "savings_pct",
            F.round(F.col("labels_saved").cast("double") / F.col("random_final_n_labeled") * 100, 1),
        )
    )


def learning_curve(*histories: DataFrame) -> DataFrame:
    """Points of all curves, long."""
    out = reduce(DataFrame.unionByName, histories)
    return out.select("strategy", "iteration", "n_labeled", "accuracy", "f1")


def compare_strategies(
    seed_rows: DataFrame,
    pool: DataFrame,
    id_col: str,
    *,
    strategy: str = "entropy",
    metric: str = "f1",
    **cycle,
) -> tuple[DataFrame, DataFrame]:
    """Run a strategy and the random baseline from the same seed: side by side, and labels saved."""
    a, _ = run_cycle(seed_rows, pool, id_col, strategy=strategy, **cycle)
    b, _ = run_cycle(seed_rows, pool, id_col, strategy="random", **cycle)
    return history_compare(a, b, (strategy, "random")), savings(a, b, metric)


def score_new(model: TextClassifier, df: DataFrame, text_col: str = "text") -> DataFrame:
    """Label and confidence of new texts under a fitted or loaded model; an existing label is kept
    as ``human_label``."""
    if "label" in df.columns:
        df = df.withColumnRenamed("label", "human_label")
    return model.transform(df, text_col).select(
        *df.columns,
        F.col("predicted").alias("label"),
        F.round(F.array_max("probability"), 4).alias("confidence"),
    )


def stratified_seed(df: DataFrame, label_col: str, id_col: str, per_class: int, seed: object = 42) -> DataFrame:
    """A seed with ``per_class`` rows of every class, for data whose first rows hold one class only."""
    w = W.partitionBy(label_col).orderBy(stable_hash(seed, id_col), id_col)
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= per_class).drop("_r")
