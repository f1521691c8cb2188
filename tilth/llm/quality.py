"""Quality filtering by weak supervision: rules vote or abstain, and EM weighs them.

Each rule looks at one measure of a text and votes *poor*, *good* or not at all.  All
documents are counted by their vector of votes; expectation-maximisation on these
counts estimates how often each rule votes poor or good on texts of either class and
the share of each class, and a document is kept if its posterior probability of being
good reaches one half.  Measures and votes are SQL expressions on the whole text; the
counts have at most ``3 ** len(RULES)`` rows, and only they reach the driver.
"""

from __future__ import annotations

import math
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.functions.store import cut

SPACE = " \t\n\x0b\x0c\r"
SPLIT = r"[\x20\x09-\x0D]+"
#: Rule: measure, votes poor from (above or below) this value, votes good up to (or from) that one.
RULES = {
    "short": ("n_words", "below", 50, 100),
    "symbols": ("n_symbols / n_words", "above", 0.3, 0.05),
    "shouting": ("n_upper / word_chars", "above", 0.4, 0.15),
    "repetition": ("n_repeat_words / n_words", "above", 0.4, 0.2),
    "double_lines": ("n_dup_lines / n_lines", "above", 0.5, 0.2),
    "word_length": ("word_chars / n_words", "above", 14, 9),
    "sentences": ("n_stops / n_words", "below", 0.01, 0.03),
    "exclamations": ("n_shouts / n_words", "above", 0.3, 0.1),
    "letters": ("n_letters / word_chars", "below", 0.75, 0.85),
    "bare_signs": ("n_bare / n_words", "above", 0.2, 0.1),
}
ROUNDS, TOLERANCE = 200, 1e-9


def _occurrences(text: str, pattern: str) -> Column:
    return (F.size(F.split(text, pattern, -1)) - 1).cast("long")


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a column ``measures``: counts of words, characters, symbols, lines and repetitions.

    A null text has no words and all counts zero.  Work is linear in the text but for
    sorting the hashes of its three-word windows, and those only if some are equal.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(whole, F.lit(SPACE))
    step = docs.withColumn("__text", whole).withColumn("__words", F.when(F.length(trimmed) > 0, F.split(trimmed, SPLIT)).otherwise(F.array().cast("array<string>")))
    step = step.withColumn("__lines", F.filter(F.split("__text", "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0))
    window = F.transform(F.sequence(F.lit(0), F.size("__words") - 3), lambda i: F.xxhash64(F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2)))
    step = step.withColumn("__windows", F.when(F.size("__words") >= 3, window).otherwise(F.array().cast("array<bigint>")))
    placed = F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeated = F.size(F.array_distinct("__windows")) < F.size("__windows")
    step = step.withColumn("__sorted", F.when(repeated, placed))
    # Each window beside the next and the previous one in the order of hashes.
    ahead = F.zip_with("__sorted", F.slice("__sorted", 2, F.greatest(F.size("__sorted"), F.lit(1))), lambda a, b: F.struct(a.h.alias("h"), a.i.alias("i"), b.h.alias("n")))
    behind = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.col("__sorted"))
    pairs = F.zip_with(ahead, behind, lambda a, b: F.when(F.coalesce(a.h == a.n, F.lit(False)) | F.coalesce(a.h == b.h, F.lit(False)), a.i))
    step = step.withColumn("__twice", F.sort_array(F.array_compact(pairs)))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
    covered = F.aggregate("__twice", zero, lambda s, i: F.struct((i + 3).alias("end"), (s.total + i + 3 - F.greatest(s.end, i)).alias("total")), lambda s: s.total)
    return step.withColumn(
        "measures",
        F.struct(
            F.size("__words").cast("long").alias("n_words"),
            F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
            _occurrences("__text", "[#*$%&|<>]").alias("n_symbols"),
            (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
            F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
            F.size("__lines").cast("long").alias("n_lines"),
            _occurrences("__text", r"\p{Lu}").alias("n_upper"),
            _occurrences("__text", "[.!?]").alias("n_stops"),
            _occurrences("__text", "!").alias("n_shouts"),
            F.length(F.regexp_replace("__text", r"\P{L}+", "")).cast("long").alias("n_letters"),
            # Words without a letter or digit.
            _occurrences("__text", r"(?<![^\x20\x09-\x0D])[^\p{L}\p{N}\x20\x09-\x0D]+(?![^\x20\x09-\x0D])").alias("n_bare"),
        ),
    ).drop("__text", "__words", "__lines", "__windows", "__sorted", "__twice")


def votes(rules: dict = RULES) -> Column:
    """The vector of votes as one number in base 3: 0 poor, 1 none, 2 good, first rule first."""
    code = F.lit(0)
    for name, (measure, side, poor, good) in rules.items():
        parts = measure.split(" / ")
        value = F.col(f"measures.{parts[0]}").cast("double")
        if len(parts) > 1:
            value = value / F.greatest(F.col(f"measures.{parts[1]}"), F.lit(1))
        is_poor, is_good = (value >= poor, value <= good) if side == "above" else (value < poor, value >= good)
        code = code * 3 + F.when(is_poor, 0).when(is_good, 2).otherwise(1)
    return code


def fit(counts: dict[int, int], n_rules: int, rounds: int = ROUNDS) -> dict[int, float]:
    """Posterior probability of *good* for each vector of votes, by EM on the counts of vectors.

    Either class draws each rule's vote from its own distribution.  The start is what
    the rules are meant to say: a poor text draws a poor vote from one rule in
    ``n_rules`` and a good text hardly ever; the same belief stays as a weak prior.
    """
    if not counts:
        return {}
    vectors = {c: [c // 3 ** (n_rules - 1 - j) % 3 for j in range(n_rules)] for c in counts}
    total = sum(counts.values())
    prior = {0: (1.0 / n_rules, 0.1, 0.9 - 1.0 / n_rules), 1: (0.002, 0.1, 0.898)}
    weight = 0.05 * total + 1
    table = {y: [list(prior[y]) for _ in range(n_rules)] for y in (0, 1)}
    share, posterior, last = 0.8, {}, -math.inf
    for _ in range(rounds):
        likelihood = 0.0
        for c, v in vectors.items():
            p = [math.log(1 - share), math.log(share)]
            for y in (0, 1):
                p[y] += sum(math.log(table[y][j][x]) for j, x in enumerate(v))
            top = max(p)
            both = top + math.log(sum(math.exp(x - top) for x in p))
            posterior[c] = math.exp(p[1] - both)
            likelihood += counts[c] * both
        good = sum(n * posterior[c] for c, n in counts.items())
        share = (good + 0.8 * weight) / (total + weight)
        for y in (0, 1):
            for j in range(n_rules):
                seen = [weight * q for q in prior[y]]
                for c, v in vectors.items():
                    seen[v[j]] += counts[c] * (posterior[c] if y else 1 - posterior[c])
                table[y][j] = [x / sum(seen) for x in seen]
        if abs(likelihood - last) <= TOLERANCE * abs(likelihood):
            break
        last = likelihood
    return posterior


def judge(docs: DataFrame, text: str = "text", rules: dict = RULES, keep_text: bool = True) -> DataFrame:
    """``docs`` (its text only if kept) with ``measures``, ``base_failed``, ``good`` (posterior) and ``kept``.

    ``base_failed``: fewer than 50 words, or more than half of the words in three-word
    windows that the text has twice.  Those are never kept.  Null and empty texts have
    no words and fail; repeated rows count once each; an empty table stays empty.
    Columns of these names in ``docs`` are replaced.
    """
    measured = measures(docs.drop("measures", "base_failed", "good", "kept", "votes"), text).withColumn("votes", votes(rules))
    # Written once: a filter on the verdict must not drag the measures through every row again.
    measured = cut(measured if keep_text else measured.drop(text))
    # As many rows as there are vectors of votes, whatever the table's size.
    counts = {r["votes"]: r["count"] for r in measured.groupBy("votes").count().collect()}
    posterior = fit(counts, len(rules))
    pairs = list(chain.from_iterable((F.lit(c), F.lit(p)) for c, p in sorted(posterior.items())))
    good = F.create_map(*pairs)[F.col("votes")] if pairs else F.lit(None).cast("double")
    m = F.col("measures")
    failed = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    return measured.withColumn("base_failed", failed).withColumn("good", good).withColumn("kept", ~F.col("base_failed") & (F.col("good") >= 0.5))


def verdicts(docs: DataFrame) -> DataFrame:
    """Per document: base measures, whether the base rules reject it, and the verdict."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judge(docs.select("doc_id", "text"), keep_text=False).select("doc_id", *(f"measures.{n}" for n in names), "base_failed", "kept", "good")
