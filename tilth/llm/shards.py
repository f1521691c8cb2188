"""Shards of near equal bytes by histogram sort.

Rows are ordered by a 128-bit key: a hash of the text, so that copies lie together,
then a hash of the id.  Candidate key boundaries are counted: bytes and rows below each
of them, over all partitions at once.  Around each wanted share the boundaries are
refined until a splitter is near enough, first along the text's hash and, where one
text alone holds more than the tolerance, along the id's hash inside it.  The rows are
then exchanged once, by the parts between the splitters, and numbered in key order.
Everything is DataFrame expressions; the driver sees counts at candidate boundaries.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.functions.store import cut

#: Candidate boundaries per round and interval, as a power of two.
PROBE_BITS = 12
#: How far from its share a shard's end may lie, as a part of a shard's bytes.
TOLERANCE = 0.002
#: Shards are numbered in parts of about so many rows.
PART_ROWS = 250_000
FEWEST_PARTS = 32


def _bin(key: Column, done: int, bits: int) -> Column:
    """Bits ``done`` to ``done + bits`` of a key, as unsigned number."""
    return F.shiftrightunsigned(F.shiftleft(key, done), 64 - bits) if done else F.shiftrightunsigned(key, 64 - bits)


def _top(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def splitters(slim: DataFrame, targets: list[float], tolerances: list[float]) -> list[tuple[int, int]]:
    """Keys ``(h, g)``, unsigned, one for each target: about that many bytes lie at smaller keys.

    Each round counts, in one pass, bytes inside the intervals that still hold a target.
    A target is settled when a boundary is within its tolerance, when its interval holds
    one row, or when the key has no further bits.
    """
    found: dict[int, tuple[int, int]] = {}
    # Target -> prefix of its interval in h and g, bits fixed in each, bytes below it.
    open_: dict[int, tuple[int, int, int, int, float]] = {i: (0, 0, 0, 0, 0.0) for i in range(len(targets))}
    while open_:
        by_depth: dict[tuple[int, int], dict[int, tuple[int, int]]] = {}
        for i, (h, g, hb, gb, _) in open_.items():
            by_depth.setdefault((hb, gb), {})[i] = (h, g)
        for (hb, gb), members in by_depth.items():
            prefixes = set(members.values())
            bits = min(PROBE_BITS, 64 - (gb if hb == 64 else hb))
            inside = _top(F.col("h"), hb).isin([h if h < 1 << 63 else h - (1 << 64) for h, _ in prefixes]) if hb else F.lit(True)
            if hb == 64 and gb:
                inside = inside & _top(F.col("g"), gb).isin([g for _, g in prefixes])
            step = _bin(F.col("g"), gb, bits) if hb == 64 else _bin(F.col("h"), hb, bits)
            counted = slim.filter(inside).groupBy(_top(F.col("h"), hb).alias("h"), (_top(F.col("g"), gb) if hb == 64 else F.lit(0).cast("long")).alias("g"), step.alias("bin")).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min("h").alias("low"), F.max("h").alias("high"))
            # At most 2 ** PROBE_BITS counts for each open interval.
            held: dict[tuple[int, int], list[tuple[int, int, int, int | None]]] = {}
            for r in counted.collect():
                held.setdefault((r["h"] % (1 << 64), r["g"] % (1 << 64)), []).append((r["bin"], r["bytes"], r["rows"], r["low"] % (1 << 64) if r["low"] == r["high"] else None))
            for i, (h, g) in members.items():
                below = open_[i][4]
                bins = sorted(held.get((h, g), []))
                numbers, ends, at = [b[0] for b in bins], [], below
                for b in bins:
                    at += b[1]
                    ends.append(at)
                k = bisect_left(ends, targets[i])
                if k == len(bins):  # no bytes at all: the end of the interval
                    found[i] = ((1 << 64), 0)
                    del open_[i]
                    continue
                before = ends[k - 1] if k else below
                rows, only = bins[k][2:]
                if rows == 1 or min(abs(targets[i] - before), abs(ends[k] - targets[i])) <= tolerances[i]:
                    edge = numbers[k] if abs(targets[i] - before) <= abs(ends[k] - targets[i]) else numbers[k] + 1
                    if hb == 64:
                        g_key = ((g << bits) + edge) << (64 - gb - bits)
                        found[i] = (h, g_key) if g_key < 1 << 64 else (h + 1, 0)
                    else:
                        found[i] = (((h << bits) + edge) << (64 - hb - bits), 0)
                    del open_[i]
                elif hb == 64:
                    nxt = (h, (g << bits) + numbers[k], 64, gb + bits, before)
                    if gb + bits == 64:  # rows with the same key: they stay together
                        near = abs(targets[i] - before) <= abs(ends[k] - targets[i])
                        found[i] = (h, nxt[1]) if near else (h, nxt[1] + 1)
                        del open_[i]
                    else:
                        open_[i] = nxt
                elif only is not None:  # copies of one text
                    open_[i] = (only, 0, 64, 0, before)
                else:
                    open_[i] = ((h << bits) + numbers[k], 0, hb + bits, 0, before)
    out, last = [], (0, 0)
    for i in range(len(targets)):
        last = max(last, found[i])
        out.append(last)
    return out


def _part(edges: list[tuple[int, int]]) -> Column:
    """Number of splitters at or below a row's key.

    The first bits of the text's hash choose a short list of splitters by array position;
    only those are compared.
    """
    bits = 12
    signed = lambda x: x - (1 << 63)  # noqa: E731  unsigned order as signed order
    clipped = [e if e[0] < 1 << 64 else None for e in edges]
    keys = [e for e in clipped if e is not None]
    tops = [e[0] >> (64 - bits) for e in keys]
    before = [bisect_left(tops, b) for b in range(1 << bits)]
    lists = [keys[bisect_left(tops, b) : bisect_right(tops, b)] for b in range(1 << bits)]
    base = F.array(*(F.lit(n) for n in before))
    # Bins without a splitter share one literal; the others are looked up in a short map.
    busy = {b: x for b, x in enumerate(lists) if x}
    top = F.shiftrightunsigned("h", 64 - bits).cast("int")
    flip = lambda c: F.col(c).bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
    inner = F.lit(0)
    if busy:
        entries = [F.array(*(F.struct(F.lit(signed(h)).cast("long").alias("h"), F.lit(signed(g)).cast("long").alias("g")) for h, g in x)) for x in busy.values()]
        where = F.array(*(F.lit(list(busy).index(b) if b in busy else -1) for b in range(1 << bits)))
        row = F.struct(flip("h").alias("h"), flip("g").alias("g"))
        inner = F.when(F.get(where, top) >= 0, F.size(F.filter(F.get(F.array(*entries), F.get(where, top)), lambda e: e <= row))).otherwise(0)
    return F.get(base, top) + inner


def parts_of(slim: DataFrame, n_shards: int, tolerance: float = TOLERANCE) -> tuple[list[tuple[int, int]], list[int]]:
    """Keys that cut the rows into parts, and the shard of each part.

    Shards end by bytes.  Inside them keys cut by bytes and keys cut by rows, so neither
    long texts nor a crowd of short ones makes a large part.
    """
    total = slim.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    if not total["rows"]:
        return [], [0]
    size, rows = total["bytes"], total["rows"]
    parts = max(FEWEST_PARTS, -(-rows // n_shards // PART_ROWS))
    n = n_shards * parts
    # The ends of shards are held to the tolerance, those of parts inside them only roughly.
    near, rough = tolerance * size / n_shards / 2, size / n / 4
    by_bytes = splitters(slim, [size * i / n for i in range(1, n)], [near if i % parts == 0 else rough for i in range(1, n)])
    by_rows = splitters(slim.withColumn("size", F.lit(1)), [rows * i / n for i in range(1, n)], [rows / n / 4] * (n - 1))
    ends = by_bytes[parts - 1 :: parts]
    inner = set(by_bytes + by_rows) - set(ends)
    edges = sorted([*ends, *inner])
    return edges, [bisect_right(ends, e) for e in [(-1, 0), *edges]]


def shard(docs: DataFrame, n_shards: int = 8, doc_id: str = "doc_id", text: str = "text", tolerance: float = TOLERANCE) -> DataFrame:
    """A row per document: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    ``size`` is the UTF-8 length plus 1 (null text: none, so 1).  Shards are ranges of
    keys whose bytes differ from an equal share by ``tolerance`` of a shard, or by less
    than one row where rows are larger than that.  Copies of a text stand next to each
    other and share a shard, unless a splitter has to cut a group to keep the sizes.  The
    slot numbers a shard's rows from 0 in key order.  Repeated rows are rows of their
    own; null ids are kept; an empty table gives an empty result.
    """
    body = F.coalesce(F.encode(F.col(text), "utf-8"), F.lit(b""))
    slim = cut(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.lit(1)).alias("h"),
            F.xxhash64(F.col(doc_id), F.lit(2)).alias("g"),
        )
    )
    edges, of = parts_of(slim, n_shards, tolerance)
    placed = slim.withColumn("part", _part(edges))
    # A row for each part: its shard, and the rows of the shard before it.
    counts = placed.groupBy("part").agg(F.count("*").alias("rows")).withColumn("of", F.get(F.lit(of), F.col("part").cast("int")))
    starts = counts.selectExpr("part as p", "of", "sum(rows) over (partition by of order by part) - rows as base")
    ranked = placed.withColumn("rank", F.expr(f"row_number() over (partition by part order by h ^ ({-(1 << 63) + 1}L - 1L), g ^ ({-(1 << 63) + 1}L - 1L), doc_id)"))
    joined = ranked.join(F.broadcast(starts), F.col("part") == F.col("p"))
    return joined.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("of").cast("int").alias("shard"),
        (F.col("base") + F.col("rank") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
