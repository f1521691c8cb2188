"""Near duplicates by HyperMinHash, confirmed on full sets.

A text's set is that of its distinct word shingles.  The first bits of a shingle's hash
choose one of ``BUCKETS`` buckets; of each bucket the smallest rest is kept, compressed
to its number of leading zeros and the ``MANTISSA`` bits behind the leading one.  A bucket
that no shingle chose takes the smallest value of all shingles under a hash of its own,
so small sets fill all registers without making them depend on each other.

``ROWS`` registers make a band; texts that agree in a band are candidates.  The share of
equal registers, less the equalities that compression makes by chance, estimates the
similarity, and what stays is counted on the sets of the texts themselves.  With 42 bands
of 6 registers a pair at a similarity of exactly 0.8 shares no band once in 350,000 times
(0.85: once in 10^9); the estimate's bound lies five standard deviations below 0.8.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.llm.similar import similar_groups
from tilth.llm.text import mix

SHINGLE, PERCENT = 2, 80
BUCKET_BITS, MANTISSA, VALUE_BITS = 8, 10, 53
BUCKETS = 1 << BUCKET_BITS
ROWS, BANDS = 6, 42
SIGMAS = 5.0
_BUCKET_SEEDS = mix(np.arange(1, BUCKETS + 1, dtype=np.uint64))


def _compress(values: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of values below 2 ** ``VALUE_BITS``, which a double holds exactly."""
    zeros = VALUE_BITS - np.frexp(values.astype(np.float64))[1]
    behind = (values << (zeros + 1).astype(np.uint64)) >> np.uint64(VALUE_BITS - MANTISSA)
    return (zeros << MANTISSA | (behind & np.uint64((1 << MANTISSA) - 1)).astype(np.int64)).astype(np.uint16)


def sketch(members: np.ndarray) -> np.ndarray:
    """The compressed registers of a set, given as ascending 64-bit hashes."""
    bucket = (members >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    rest = (members << np.uint64(BUCKET_BITS)) >> np.uint64(64 - VALUE_BITS)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))  # ascending: the smallest of its bucket
    registers = np.full(BUCKETS, np.iinfo(np.uint64).max)
    registers[bucket[first]] = rest[first]
    empty = np.ones(BUCKETS, bool)
    empty[bucket[first]] = False
    for seeds in np.array_split(np.flatnonzero(empty), 1 + int(empty.sum()) * len(members) // 1_000_000):
        registers[seeds] = (mix(members[None, :] ^ _BUCKET_SEEDS[seeds, None]) >> np.uint64(64 - VALUE_BITS)).min(axis=1) if len(seeds) else 0
    return _compress(registers)


@functools.lru_cache(maxsize=1)
def _chance() -> np.ndarray:
    """Chance that registers of sets without a common member agree, by the binary logarithms of their sizes."""
    sizes = 2.0 ** np.arange(32)[:, None]
    edges = np.concatenate([[0.0], (2.0 ** np.arange(-VALUE_BITS, 0)[:, None] * (1 + np.arange(1 << MANTISSA) / (1 << MANTISSA))).ravel(), [1.0]])
    void = (1 - 1 / BUCKETS) ** sizes
    below = -np.expm1(sizes * np.log1p(-edges / BUCKETS)) + void * -np.expm1(sizes * np.log1p(-np.minimum(edges, 1 - 1e-16)))
    cells = np.diff(below, axis=1)
    return cells @ cells.T


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity by rows of registers, corrected for chance equalities."""
    chance = _chance()[np.log2(n_a).round().astype(int), np.log2(n_b).round().astype(int)]
    return ((a == b).mean(axis=1) - chance) / (1 - chance)


class Registers:
    """HyperMinHash as a sketch for ``similar_groups``."""

    kind, size, passes = np.dtype(np.uint16), BUCKETS, 1

    def make(self, members: np.ndarray) -> np.ndarray:
        return sketch(members)

    def keys(self, rows: np.ndarray, part: int) -> np.ndarray:
        """A key for each band of registers."""
        table = rows.astype(np.uint64)
        keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(rows), BANDS))
        for k in range(ROWS):
            keys = mix(keys * np.uint64(1 << 16) + table[:, k : ROWS * BANDS : ROWS])
        return keys

    def near(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
        least = percent / 100
        return estimate(a, b, n_a, n_b) >= least - SIGMAS * float(np.sqrt(least * (1 - least) / BUCKETS))


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``: the smallest id that links reach; see ``similar_groups``."""
    return similar_groups(docs, Registers(), percent, shingle, doc_id, text)


def digests(docs: DataFrame) -> DataFrame:
    return near_groups(docs).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sets as (select doc_id, case when len(w) = 0 then [] when len(w) = 1 then w else list_sort(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) end as s from w),
keyed as (select doc_id, len(s) as n, md5(array_to_string(s, chr(10))) as k, s from sets),
one as (select k, min(doc_id) as least, any_value(n) as n, any_value(s) as s from keyed where n > 0 group by k),
parts as (select k, n, unnest(s) as x from one),
links as (select a.k as a, b.k as b from parts a join parts b on a.x = b.x and a.k < b.k and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) group by a.k, b.k, a.n, b.n
 having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
ties as (select a, b from links union all select b, a from links),
reach as (select k, k as to_k from one union select r.k, l.b from reach r join ties l on l.a = r.to_k),
groups as (select r.k, min(o.least) as component_id from reach r join one o on o.k = r.to_k group by r.k)
select d.doc_id, d.n as n_shingles, case when d.n = 0 then d.doc_id else g.component_id end as component_id, d.n = 0 or d.doc_id = g.component_id as kept from keyed d left join groups g on g.k = d.k and d.n > 0
"""
