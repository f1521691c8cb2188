"""URL verdicts: rules by longest match, and boosted trees on lexical features for the rest.

The rules label all URLs that they fit.  From a bounded sample of these,
gradient-boosted trees learn a verdict from lexical features (lengths, depth, digits,
entropy, parameters, statistics of the host's suffix) and judge the URLs that no rule
fits.  Suffix statistics are counted over all rows.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Host and path of each rule, and its verdict.
RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
#: At most so many distinct labelled URLs train the trees: of each class those whose hash comes first.
TRAINING_ROWS = 100_000
TREES, TREE_DEPTH = 10, 4
FEATURES = ["url_length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "parameters", "labels", "hyphens", "suffix_rate", "suffix_allowed"]


def host_of(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(rules: dict[str, str], host: str = "host", path: str = "path") -> Column:
    """The longest rule that fits: its host or a subdomain of it, and a path that starts with its path."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        rule_host, slash, rest = rule.partition("/")
        fits = ((F.col(host) == rule_host) | F.col(host).endswith("." + rule_host)) & F.col(path).startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _lexical(df: DataFrame, url: str) -> DataFrame:
    text = F.coalesce(F.col(url), F.lit(""))
    size = F.greatest(F.length(text), F.lit(1))
    signs = F.split(text, "")
    # Share of each distinct sign, by what its removal takes away.
    shares = F.transform(F.array_distinct(signs), lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / size)
    entropy = F.aggregate(shares, F.lit(0.0), lambda h, p: h - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    count = lambda c, pattern: (F.size(F.split(c, pattern, -1)) - 1).cast("double")
    return df.withColumns(
        {
            "url_length": F.length(text).cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "depth": count(F.col("path"), "/[^/]"),
            "digit_ratio": F.length(F.regexp_replace(text, "[^0-9]+", "")) / size,
            "entropy": F.coalesce(entropy, F.lit(0.0)),
            "parameters": count(text, "[?&][^=&#]+="),
            "labels": count(F.col("host"), "[.]"),
            "hyphens": count(text, "-"),
            "suffix": F.substring_index("host", ".", -1),
        }
    )


def judge(pages: DataFrame, url: str = "url", rules: dict[str, str] = RULES, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``score`` (of the trees, to be allowed) and ``verdict``.

    A fitting rule decides; otherwise the trees do.  A null url, or one without ``://``,
    has an empty host and path and is judged by the trees.  Where the labelled rows are
    all of one class that class is the verdict, and without any it is ``allow``.
    Repeated rows count each; an empty table stays empty.  Columns of these names are
    replaced.
    """
    base = pages.drop("host", "path", "rule", "score", "verdict", *FEATURES, "suffix", "__label")
    base = base.withColumns({"host": host_of(url), "path": path_of(url)})
    base = base.withColumn("rule", rule_for(rules))
    allowed = [r for r, v in rules.items() if v == "allow"]
    base = base.withColumn("__label", F.when(F.col("rule").isNotNull(), F.col("rule").isin(allowed).cast("double")))
    lexical = _lexical(base, url)
    # A row for each last label of a host: how frequent it is, and how often the rules allow it.
    total = F.sum("n").over(_all())
    suffixes_of = lexical.groupBy("suffix").agg(F.count("*").alias("n"), F.sum("__label").alias("good"), F.count("__label").alias("labelled"))
    suffixes = suffixes_of.select(F.col("suffix").alias("__suffix"), (F.col("n") / total).alias("suffix_rate"), ((F.coalesce("good", F.lit(0.0)) + 1) / (F.col("labelled") + 2)).alias("suffix_allowed"))
    joined = lexical.join(suffixes, F.col("suffix") == F.col("__suffix"), "left").drop("__suffix")
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="__features", handleInvalid="keep")
    assembled = assembler.transform(joined)
    # Copies of a URL are one row of the sample and count by their weight.
    copies = base.filter("__label is not null").groupBy(F.col(url).alias("__url")).agg(F.max("__label").alias("label"), F.count("*").alias("n"))
    first = lambda df, label, n: df.filter(F.col("label") == label).orderBy(F.xxhash64("__url", F.lit(11)), "__url").limit(n)
    sample = first(copies, 0.0, training_rows).unionAll(first(copies, 1.0, training_rows)).persist()
    try:
        found = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
        classes = set(found)
        if len(classes) == 2:
            half = training_rows // 2
            taken = [first(sample, c, max(half, training_rows - found[1.0 - c])) for c in (0.0, 1.0)]
            taken = taken[0].unionAll(taken[1])
            # Each class weighs as much as all its rows, also where only a part of its URLs was taken.
            rows = suffixes_of.agg(F.sum(F.col("labelled") - F.col("good")).alias("b"), F.sum("good").alias("a")).first()
            held = {r["label"]: r["n"] for r in taken.groupBy("label").agg(F.sum("n").alias("n")).collect()}
            weight = F.col("n") * F.when(F.col("label") == 1.0, rows["a"] / held[1.0]).otherwise(rows["b"] / held[0.0])
            named = taken.select("label", F.col("__url").alias(url), weight.alias("weight")).withColumns({"host": host_of(url), "path": path_of(url)})
            rated = _lexical(named, url).join(suffixes, F.col("suffix") == F.col("__suffix"), "left")
            training = assembler.transform(rated).select("label", "weight", F.col("__features").alias("features"))
            model = GBTClassifier(weightCol="weight", maxIter=TREES, maxDepth=TREE_DEPTH, seed=1, checkpointInterval=-1, cacheNodeIds=False).fit(training)
            model.setFeaturesCol("__features").setProbabilityCol("__probability").setPredictionCol("__prediction").setRawPredictionCol("__raw")
            scored = model.transform(assembled).withColumn("score", vector_to_array("__probability")[1])
        else:
            scored = assembled.withColumn("score", F.lit(classes.pop() if classes else 1.0))
    finally:
        sample.unpersist()
    verdict = F.when(F.coalesce(F.col("__label"), F.col("score")) >= 0.5, "allow").otherwise("block")
    return scored.withColumn("verdict", verdict).drop("__label", "__features", "__probability", "__prediction", "__raw", "suffix", *FEATURES)


def _all():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(1))


def verdicts(pages: DataFrame) -> DataFrame:
    return judge(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "score")
