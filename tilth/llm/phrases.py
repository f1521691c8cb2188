"""Collocations: phrases whose words stand together more often than their parts would by chance.

Each word has a hash, and a text's words give a prefix polynomial in them, so that the
Rabin-Karp fingerprint of any run of words is one difference and one product: numpy
hashes all runs of a length at once.  Fingerprints are counted by shuffle: all words and
pairs in one scan, longer runs after one another.  A phrase can only be frequent if the two
phrases one word shorter are, so a bitmap of fixed size of the frequent fingerprints of one
length thins those of the next in the scan.  On data beyond any bound the bitmap fills and
thins less; counts stay exact.

Only frequent phrases are read back: tasks point to an occurrence of each and cut it from
the text, in a part of the rows first, and for what that part does not hold in all.  Each
occurrence has added a second, independent hash of its words to its fingerprint's sum,
which must be the count times that of the phrase read back; fingerprints that collide break
this, and then everything is counted anew under another seed.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilth.functions.store import cut
from tilth.llm.text import SOLID, Words, mix, slices

LONGEST, FEWEST, TOP = 5, 100, 2000
#: Bytes that end a piece of text: no phrase runs across them.
BREAKS = np.zeros(256, bool)
BREAKS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
#: Bits of the bitmap: 8 MB whatever the number of frequent phrases.
BITMAP_BITS = 26
#: Texts whose words are held as arrays at once: these take some 30 times the room.
SLICE_BYTES = 1 << 20
#: Frequent phrases of a length that a task remembers to have told: some megabytes.
HELD_ROWS = 1_000_000
#: Phrases are looked for in one of so many rows first; one that is frequent stands in several of them.
THIN = 16
#: Modulus of the second hash: a sum over 2 ** 40 occurrences stays a long.
PRIME = 8_388_593
BASE = 0x9E3779B97F4A7C15


@functools.lru_cache(maxsize=8)
def _powers(base: int, modulus: int | None, bits: int) -> np.ndarray:
    """The first 2 ** ``bits`` powers of ``base``, modulo a prime or, with none, 2 ** 64."""
    out = np.ones(1, np.uint64)
    for k in range(bits):
        step = np.uint64(pow(base, 1 << k, modulus or 1 << 64))
        more = out * step
        out = np.concatenate([out, more if modulus is None else more % np.uint64(modulus)])
    return out


class Runs:
    """Fingerprints of runs of words in a column of texts.

    Two lanes, each a polynomial in the bytes of a word and one in the words of a run:
    fingerprints modulo 2 ** 64, and the second hash modulo a prime.
    """

    def __init__(self, texts: pa.Array, langs: pa.Array, seed: int) -> None:
        self.words = words = Words(texts, SOLID & ~BREAKS)
        n = len(words.starts)
        self.of = np.repeat(np.arange(len(texts)), np.diff(words.bounds))
        breaks = np.cumsum(BREAKS[words.data])[words.starts] if n else np.zeros(0, np.int64)
        fresh = np.ones(n, bool)
        fresh[1:] = (np.diff(breaks) > 0) | (np.diff(self.of) > 0)
        edges = np.append(np.flatnonzero(fresh), n)
        #: Words from each one to the end of its piece.
        self.left = np.repeat(edges[1:], np.diff(edges)) - np.arange(n)
        data, sizes = words.data[words.solid], words.ends - words.starts
        heads = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        inside = np.arange(len(data), dtype=np.int32) - np.repeat(heads, sizes).astype(np.int32)
        deep, long = int(sizes.max(initial=1)).bit_length(), max(1, n).bit_length()
        self.lanes = []
        for modulus in (None, PRIME):
            base = BASE if modulus is None else BASE % PRIME
            # Bytes times powers of the prime stay below 2 ** 31, so sums over any word stay exact.
            word = np.add.reduceat(_powers(base, modulus, deep)[inside] * data, heads) if n else np.zeros(0, np.uint64)
            rise, fall = _powers(base, modulus, long), _powers(pow(base, -1, modulus or 1 << 64), modulus, long)
            if modulus is None:
                steps = mix(word + sizes.astype(np.uint64) + np.uint64(2 * seed)) * rise[:n]
            else:
                steps = (word + sizes.astype(np.uint64) * np.uint64(2 * seed + 1)) % np.uint64(PRIME) * rise[:n] % np.uint64(PRIME)
            self.lanes.append((np.concatenate([[np.uint64(0)], np.cumsum(steps, dtype=np.uint64)]), fall))
        known = langs.dictionary_encode()
        self.lang = np.array([xxhash.xxh64_intdigest(x.encode(), seed) for x in known.dictionary.to_pylist()], np.uint64)[np.asarray(known.indices)][self.of]

    def at(self, first: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """Fingerprint of the ``n`` words from each word of ``first`` on."""
        prefix, fall = self.lanes[0]
        polynomial = (prefix[first + n] - prefix[first]) * fall[first]
        return mix(mix(polynomial + np.asarray(n).astype(np.uint64)) ^ self.lang[first])

    def check(self, first: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """The second hash of the same words."""
        prefix, fall = self.lanes[1]
        return ((prefix[first + n] - prefix[first]) % np.uint64(PRIME) * fall[first] % np.uint64(PRIME)).astype(np.int64)


def _held(bitmap: np.ndarray, prints: np.ndarray) -> np.ndarray:
    slot = (prints >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
    return bitmap[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 > 0


def _bitmap(frequent: DataFrame) -> np.ndarray:
    """The bits of all fingerprints, put together from the blocks of 4 KB that Spark fills."""
    slot = F.shiftrightunsigned("fp", 64 - BITMAP_BITS) + 1  # the functions count from 1
    blocks = frequent.groupBy(F.bitmap_bucket_number(slot).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    out = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for r in blocks.toLocalIterator():
        start = (r["block"] - 1) * 4096
        out[start : start + 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def _first_words(runs: Runs, n: int, shorter: np.ndarray | None) -> np.ndarray:
    """Where runs of ``n`` words begin whose two parts of one word less are in the bitmap."""
    first = np.flatnonzero(runs.left >= n)
    if shorter is not None and len(first):
        first = first[_held(shorter, runs.at(first, n - 1)) & _held(shorter, runs.at(first + 1, n - 1))]
    return first


def _counted(given: DataFrame, lengths: tuple[int, ...], shorter: np.ndarray | None, seed: int) -> DataFrame:
    """``n``, ``fp``, ``lang``, ``f``, ``weight``: fingerprints of runs of these lengths, as counted in parts of the table.

    ``weight`` sums the second hash over all occurrences.  Rows of single words with a
    ``lang`` and no fingerprint hold the number of all words.
    """
    bits = None if shorter is None else given.sparkSession.sparkContext.broadcast(shorter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(n: int, prints: pa.Array, langs: pa.Array, counts: pa.Array, weights: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(counts), n, np.int32)), prints, langs, counts, weights], names=["n", "fp", "lang", "f", "weight"])

        for batch in slices(batches, "text", SLICE_BYTES):
            runs = Runs(batch.column("text"), batch.column("lang"), seed)
            for n in lengths:
                first = _first_words(runs, n, None if bits is None else bits.value)
                prints = runs.at(first, n)
                order = np.argsort(prints)
                prints, first = prints[order], first[order]
                starts = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]])) if len(prints) else np.zeros(0, np.int64)
                counts = np.diff(np.append(starts, len(prints)))
                weights = np.add.reduceat(runs.check(first, n), starts) if len(starts) else counts
                yield rows(n, pa.array(prints[starts].view(np.int64)), pa.nulls(len(starts), pa.string()), pa.array(counts), pa.array(weights))
            if 1 in lengths:
                totals = pa.table([batch.column("lang"), pa.array(np.diff(runs.words.bounds))], names=["lang", "f"]).group_by("lang").aggregate([("f", "sum")])
                nothing = pa.nulls(len(totals), pa.int64())
                yield rows(1, nothing, totals["lang"].combine_chunks(), totals["f_sum"].combine_chunks(), nothing)

    return given.mapInArrow(run, "n int, fp long, lang string, f long, weight long")


def _read_back(given: DataFrame, bitmaps: dict[int, np.ndarray], seed: int, thin: int) -> DataFrame:
    """``fp``, ``lang``, ``phrase``, ``check``, and fingerprints of its first and its other words at each cut.

    Phrases whose fingerprint is in the bitmap of their length, from the rows whose hash
    is divisible by ``thin``.  A task points to the first occurrence of each that it meets,
    and cuts the phrase from the text there.
    """
    bits = given.sparkSession.sparkContext.broadcast(bitmaps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: dict[int, np.ndarray] = {}
        for batch in slices(batches, "text", SLICE_BYTES):
            runs = Runs(batch.column("text"), batch.column("lang"), seed)
            content, langs = runs.words.data, batch.column("lang").to_pylist()
            out: list[tuple] = []
            for n, bitmap in sorted(bits.value.items()):
                first = np.flatnonzero(runs.left >= n)
                prints = runs.at(first, n)
                kept = _held(bitmap, prints)
                prints, at = np.unique(prints[kept], return_index=True)
                first = first[kept][at]
                known = told.get(n, prints[:0])
                fresh = ~np.isin(prints, known, assume_unique=True)
                prints, first = prints[fresh], first[fresh]
                # What a task has told is remembered up to a bound; telling it again does no harm.
                told[n] = np.union1d(known, prints) if len(known) < HELD_ROWS else prints
                heads = [runs.at(first, j).view(np.int64).tolist() for j in range(1, n)]
                tails = [runs.at(first + j, n - j).view(np.int64).tolist() for j in range(1, n)]
                check = runs.check(first, n).tolist()
                for k, (f, a) in enumerate(zip(prints.view(np.int64).tolist(), first.tolist(), strict=True)):
                    words = [content[runs.words.starts[a + j] : runs.words.ends[a + j]].tobytes() for j in range(n)]
                    out.append((f, langs[runs.of[a]], b" ".join(words).decode(), check[k], [h[k] for h in heads], [t[k] for t in tails]))
            types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(types)], names=["fp", "lang", "phrase", "check", "heads", "tails"])

    chosen = given.filter(F.pmod("th", F.lit(thin)) == 0) if thin > 1 else given
    found = chosen.mapInArrow(run, "fp long, lang string, phrase string, check long, heads array<bigint>, tails array<bigint>")
    return found.dropDuplicates(["fp"])


def candidates(docs: DataFrame, text: str = "text", lang: str = "lang", fewest: int = FEWEST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent phrases of 2 to ``longest`` words, the counts of all frequent runs (``fp``, ``f``), and words of each language.

    Phrases have ``fp``, ``lang``, ``phrase``, ``a`` (how often), ``heads`` and ``tails``.
    """
    given = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text", "lang"))
    for seed in count():
        levels, bitmaps, totals = {}, {}, None
        # Single words and pairs are all counted, in one scan; from three words on the shorter runs thin them.
        for lengths in ((1, 2), *((n,) for n in range(3, longest + 1))):
            rows = _counted(given, lengths, bitmaps.get(lengths[0] - 1), seed)
            summed = rows.groupBy("n", "fp", "lang").agg(F.sum("f").alias("f"), F.sum("weight").alias("weight"))
            every = cut(summed.filter((F.col("f") >= fewest) | F.col("fp").isNull()))
            if 1 in lengths:
                totals = every.filter("fp is null").select("lang", F.col("f").alias("n"))
                every = every.filter("fp is not null")
            for n in lengths:
                levels[n] = every.filter(F.col("n") == n).select("n", "fp", "f", "weight")
                if n > 1:
                    bitmaps[n] = _bitmap(levels[n])
        longer = levels[2]
        for n in range(3, longest + 1):
            longer = longer.unionByName(levels[n])
        # Nearly all are found in a part of the rows, and what is not in a scan for it alone.
        known = cut(_read_back(given, bitmaps, seed, THIN).join(longer.select("fp"), "fp", "left_semi"))
        missing = cut(longer.select("n", "fp").join(known, "fp", "left_anti"))
        if not missing.isEmpty():
            rest = {n: _bitmap(missing.filter(F.col("n") == n)) for n in range(2, longest + 1)}
            known = known.unionByName(_read_back(given, rest, seed, 1).join(missing.select("fp"), "fp", "left_semi"))
        joined = cut(longer.join(known, "fp", "left"))
        # Every frequent fingerprint must have been read back, and each of its occurrences must be that phrase.
        if joined.filter(~F.coalesce(F.col("weight") == F.col("f") * F.col("check"), F.lit(False))).isEmpty():
            counts = levels[1].select("fp", "f").unionByName(longer.select("fp", "f"))
            return joined.select("fp", "lang", "phrase", F.col("f").alias("a"), "heads", "tails"), counts, totals
    raise AssertionError("unreachable")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", fewest: int = FEWEST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases by score: lang, rank, phrase, a, l, r, n, score.

    A null language is ``und``, a null text is empty; copies and repeated rows count as
    often as they stand in the table; a table without frequent phrases gives none.
    """
    phrases, counts, totals = candidates(docs, text, lang, fewest, longest)
    # A phrase one word longer that is as frequent is enough: anything longer still is no more frequent.
    wider = phrases.filter(F.size("heads") > 1).select(F.explode(F.array(F.element_at("heads", -1), F.element_at("tails", 1))).alias("fp"), "a")
    covered = wider.groupBy("fp").agg(F.max("a").alias("longer"))
    kept = phrases.join(covered, "fp", "left").filter(F.coalesce(F.col("longer") < F.col("a"), F.lit(True)))
    cuts = kept.select("fp", "lang", "phrase", "a", F.posexplode(F.arrays_zip("heads", "tails")).alias("k", "part")).select("fp", "lang", "phrase", "a", "k", "part.heads", "part.tails")
    left = counts.select(F.col("fp").alias("heads"), F.col("f").alias("l"))
    right = counts.select(F.col("fp").alias("tails"), F.col("f").alias("r"))
    scored = cuts.join(left, "heads").join(right, "tails").join(totals, "lang")
    # 1000 a n takes at most 38 digits, l r at most 32; the quotient is cut to a whole number exactly.
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0))) div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))")
    best = scored.withColumn("score", score).groupBy("fp", "lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    ranked = best.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase"))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", "n", "best.score")


SQL = r"""
with p as (select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
runs as (select lang, w, unnest(range(1, len(w) + 1)) as i from w),
grams as (select lang, k, array_to_string(w[i : i + k - 1], ' ') as g from runs, unnest([1, 2, 3, 4, 5]) t(k) where i + k - 1 <= len(w)),
f as (select lang, k, g, count(*) as f from grams group by all having count(*) >= 100),
total as (select lang, sum(len(w)) as n from w group by lang),
c as (select lang, k, g, f as a, string_split(g, ' ') as w from f where k > 1),
longer as (select lang, array_to_string(w[1 + s : k - 1 + s], ' ') as g, max(a) as longer from c, unnest([0, 1]) t(s) where k > 2 group by 1, 2),
kept as (select c.* from c left join longer o on o.lang = c.lang and o.g = c.g where o.longer is null or o.longer < c.a),
cuts as (select lang, g, k, a, w, unnest(range(1, k)) as j from kept),
scored as (select u.lang, u.g, u.a, u.j, x.f as l, y.f as r, t.n, (1000::hugeint * u.a * t.n) // (x.f::hugeint * y.f) as score from cuts u join total t on t.lang = u.lang
 join f x on x.lang = u.lang and x.g = array_to_string(u.w[1 : u.j], ' ') join f y on y.lang = u.lang and y.g = array_to_string(u.w[u.j + 1 : u.k], ' ')),
best as (select * from scored qualify row_number() over (partition by lang, g order by score, j) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, g) as rank from best)
select lang, rank, g as phrase, a, l, r, n::bigint as n, score::bigint as score from ranked where rank <= 2000
"""
