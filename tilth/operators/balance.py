"""Class weights and resampling to equal class sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilth.functions.hashing import hash_number, hash_ranked, hash_unit, stable_hash
from tilth.operators.detect import class_counts, imbalance
from tilth.operators.neighbors import knn_join
from tilth.operators.sampling import undersample

# New rows are generated in chunks of this many, spread over the cluster.
CHUNK_ROWS = 100_000


def class_weights(df: DataFrame, label_col: str) -> DataFrame:
    """rows / (classes * class rows) per class; a null label counts as a class."""
    counts = df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    whole = W.partitionBy()
    return counts.withColumn(
        "weight",
        F.round(
            F.sum("count").over(whole).cast("double")
            / (F.count(F.lit(1)).over(whole) * F.col("count")),
            4,
        ),
    )


def _new_rows(df: DataFrame, label_col: str, seed: object) -> DataFrame:
    """One row (label, size, j, digest) per row a class lacks to reach the largest class."""
    counts = class_counts(df, label_col)
    largest = counts.agg(F.max("count")).scalar()
    deficits = counts.withColumn("_missing", largest - F.col("count")).filter("_missing > 0")
    chunks = deficits.select(
        F.col("label").alias("_label"),
        F.col("count").alias("_size"),
        "_missing",
        F.explode(
            F.sequence(F.lit(0).cast("long"), F.floor((F.col("_missing") - 1) / CHUNK_ROWS))
        ).alias("_chunk"),
    ).repartition("_label", "_chunk")
    first = F.col("_chunk") * CHUNK_ROWS
    last = F.least(first + CHUNK_ROWS, F.col("_missing")) - 1
    return chunks.select("_label", "_size", F.explode(F.sequence(first, last)).alias("_j")).withColumn(
        "_digest", stable_hash(seed, F.col("_label"), F.col("_j"))
    )


def oversample(df: DataFrame, label_col: str, id_col: str, seed: object = 42) -> DataFrame:
    """Repeat random rows of smaller classes, with replacement, up to the largest class.

    All original rows are kept (``copy`` 0); null labels are dropped.  Each new row
    draws an index into its class by hash, so it is one equi-join on (label, index)
    with keys spread over the class, however large.
    """
    labelled = df.filter(F.col(label_col).isNotNull())
    indexed = hash_ranked(labelled, [label_col], id_col, seed).withColumn("_index", F.col("_rank") - 1)
    wanted = _new_rows(labelled, label_col, seed).select(
        "_label",
        (hash_number(F.col("_digest")) % F.col("_size")).alias("_pick"),
        (F.col("_j") + 1).alias("copy"),
    )
    extra = (
        indexed.drop("_rank", "_size")
        .join(wanted, (F.col(label_col) == F.col("_label")) & (F.col("_index") == F.col("_pick")))
        .select(*df.columns, "copy")
    )
    return labelled.withColumn("copy", F.lit(0).cast("long")).unionByName(extra)


def smote(
    df: DataFrame,
    label_col: str,
    id_col: str,
    features: Sequence[str],
    k: int = 5,
    seed: object = 42,
) -> DataFrame:
    """Synthetic rows between same-class neighbours until all classes are equally large.

    Only the label and numeric features survive; ``synthetic`` marks new rows.
    Neighbours are searched for the classes that need new rows, within the class.
    """
    base = df.filter(F.col(label_col).isNotNull()).select(
        label_col, id_col, *[F.col(c).cast("double").alias(c) for c in features]
    )
    indexed = hash_ranked(base, [label_col], id_col, seed).withColumn("_index", F.col("_rank") - 1)
    digest = F.col("_digest")
    wanted = _new_rows(base, label_col, seed).select(
        "_label",
        "_j",
        (hash_number(digest) % F.col("_size")).alias("_pick"),
        (hash_number(F.md5(F.concat(digest, F.lit("n")))) % F.least(F.lit(k), F.greatest(F.col("_size") - 1, F.lit(1)))).alias("_nth"),
        hash_unit(F.md5(F.concat(digest, F.lit("u")))).alias("_u"),
    )
    drawn = indexed.drop("_rank", "_size").join(
        wanted, (F.col(label_col) == F.col("_label")) & (F.col("_index") == F.col("_pick"))
    )
    vector = F.array(*features).alias("_vector")
    small = class_counts(base, label_col)
    largest = small.agg(F.max("count")).scalar()
    minority = base.join(
        small.filter(F.col("count") < largest).select(F.col("label").alias("_m")),
        F.col(label_col) == F.col("_m"), "left_semi",
    ).select(label_col, id_col, vector)
    near = knn_join(
        minority, minority, k, id_col, id_col, "_vector", by=label_col, exclude_self=True
    )
    partners = base.select(F.col(id_col).alias("_pid"), *[F.col(c).alias(f"_p_{c}") for c in features])
    # A class of one row has no neighbour and repeats itself.
    pairs = (
        drawn.join(
            near.select(F.col("query_id").alias("_qid"), (F.col("rank") - 1).alias("_rk"), "donor_id"),
            (F.col(id_col) == F.col("_qid")) & (F.col("_nth") == F.col("_rk")),
            "left",
        )
        .join(partners, F.col("donor_id") == F.col("_pid"), "left")
    )
    made = pairs.select(
        label_col,
        *[
            (F.col(c) + F.col("_u") * (F.coalesce(F.col(f"_p_{c}"), F.col(c)) - F.col(c))).alias(c)
            for c in features
        ],
        F.lit(True).alias("synthetic"),
    )
    return base.select(label_col, *features, F.lit(False).alias("synthetic")).unionByName(made)


def auto_balance(
    df: DataFrame, label_col: str, id_col: str, how: str = "undersample", min_ratio: float = 5.0,
    seed: object = 42,
) -> DataFrame:
    """Resample only when the class ratio is at least ``min_ratio``."""
    ratio = imbalance(df, label_col).first()["ratio"]
    if ratio is None or ratio < min_ratio:
        return df
    if how == "undersample":
        return undersample(df, label_col, id_col, seed=seed)
    return oversample(df, label_col, id_col, seed).drop("copy")
