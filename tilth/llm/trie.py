"""Trie of rebuilt conversations as balanced parentheses.

``rebuild`` gives every conversation the first turns of another one, as regenerated or
branched chats have them.  Each distinct sequence of first turns is a node.  A turn is
known by a 128-bit digest of its role, text and depth, and a node by the exclusive-or of
the digests on its path, so no text leaves the scan.

Paths are cut into bands of ``BAND`` turns, so no row and no sort key grows with the
length of a conversation.  Distinct paths are exchanged by range of their nodes; a part
of that order is a shard, and its trie is written as a sequence of parentheses.  Range
minima of the excess over blocks find the close of each node, which delimits its
subtree; the rank of leaf pairs counts its leaves, and differences of cumulative arrays
give its members and savings.  Nodes that a neighbouring shard also has are its spines:
their parts add up and are merged by node.  What hangs below a band is summed first and
enters the band above as a weight at the node that it hangs on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilth.functions.store import cut

#: A conversation takes at most this many turns less one from the first of its group of ``GROUP``.
HEADS, GROUP = 9, 5
#: Turns of a path in one row, and turns of distinct paths in one shard, about.
BAND, SHARD_TURNS = 256, 200_000
#: A spine's node may have very many children; they look for it under so many salts.
SALTS = 32
#: Bits in a block of the excess directory.
BLOCK = 64
NODE, HEADER = 16, 20
NOTHING = hashlib.sha256(b"").hexdigest()


class Parens:
    """A sequence of parentheses (true opens) with a tree of excess minima over its blocks."""

    def __init__(self, opens: np.ndarray) -> None:
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1), dtype=np.int64)
        blocks = -(-len(opens) // BLOCK)
        padded = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        padded[: len(opens)] = self.excess
        self.levels = [padded.reshape(blocks, BLOCK).min(axis=1)]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            if len(below) % 2:
                below = np.append(below, np.iinfo(np.int64).max)
                self.levels[-1] = below
            self.levels.append(below.reshape(-1, 2).min(axis=1))

    def _scan(self, at: np.ndarray, want: np.ndarray, found: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Look from ``at`` to the end of its block; gives which of ``which`` found nothing."""
        missed = []
        while len(which):
            inside = at < len(self.excess)
            hit = np.zeros(len(which), bool)
            hit[inside] = self.excess[at[inside]] == want[inside]
            found[which[hit]] = at[hit]
            at, want, which = at[~hit] + 1, want[~hit], which[~hit]
            over = at % BLOCK == 0
            missed.append(which[over])
            at, want, which = at[~over], want[~over], which[~over]
        return np.concatenate(missed) if missed else which

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one at ``at``."""
        want, found = self.excess[at] - 1, np.full(len(at), -1)
        far = self._scan(at + 1, want, found, np.arange(len(at))) if len(at) else np.zeros(0, np.int64)
        # An opening one at the end of its block is looked for from the next block on.
        node, level = (at[far] + 1 + BLOCK - 1) // BLOCK, np.zeros(len(far), np.int64)
        sought = want[far]
        down = np.zeros(len(far), bool)
        while not (down & (level == 0)).all():
            for k in range(len(self.levels)):
                here = np.flatnonzero(level == k)
                if not len(here):
                    continue
                low = self.levels[k]
                ok = low[node[here]] <= sought[here]
                falling = here[ok | down[here]]
                down[falling] = True
                if k:
                    left = self.levels[k - 1][2 * node[falling]] <= sought[falling]
                    node[falling] = 2 * node[falling] + ~left
                    level[falling] = k - 1
                rising = here[~ok & ~down[here]]
                node[rising] += 1
                up = rising[node[rising] % 2 == 0]
                node[up] //= 2
                level[up] = k + 1
        if len(far):
            self._scan(node * BLOCK, sought, found, far)
        return found


def rebuild(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations (``conv``, ``n_turns``) and their turns (``conv``, ``depth``, ``a``, ``b``, ``size``).

    Turns are ordered by turn, null first, ties by role and then by a digest of the
    text; repeated rows are turns of their own.  A null role or text is empty; rows
    without a conversation id belong to none.  The order is counted in stretches of
    ``BAND`` turn numbers, so a very long conversation is not numbered in one task.
    """
    said = F.concat(F.octet_length(F.coalesce(role, F.lit(""))).cast("string"), F.lit(":"), F.coalesce(role, F.lit("")), F.coalesce(text, F.lit("")))
    slim = cut(
        conversations.filter(F.col(conv_id).isNotNull()).select(
            F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.unhex(F.md5(said)).alias("said"),
            F.octet_length(F.coalesce(text, F.lit(""))).cast("long").alias("size"), F.coalesce(F.floor(F.col(turn) / BAND).cast("long"), F.lit(-(1 << 62))).alias("stretch"),
        )
    )
    stretches = slim.groupBy("conv", "stretch").agg(F.count("*").alias("rows"))
    own = stretches.groupBy("conv").agg(F.sum("rows").alias("n"))
    head = own.select("conv", "n", F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(HEADS)).alias("h"), (F.col("conv") - F.col("conv") % GROUP).alias("base"))
    first = own.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    convs = head.join(first, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = cut(convs.select("conv", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns")))
    before = F.coalesce(F.sum("rows").over(W.partitionBy("conv").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = stretches.select("conv", "stretch", before.alias("before")).join(convs.select("conv", "h", "taken"), "conv")
    order = W.partitionBy("conv", "stretch").orderBy(F.asc_nulls_first("turn"), "role", "said")
    placed = slim.join(starts, ["conv", "stretch"]).select("conv", (F.row_number().over(order) + F.col("before")).alias("at"), "h", "taken", "said", "size")
    tails = placed.filter("at > h").select("conv", (F.col("at") - F.col("h") + F.col("taken")).alias("depth"), "said", "size")
    lent = placed.filter((F.col("conv") % GROUP == 0) & (F.col("at") < HEADS)).select(F.col("conv").alias("base"), F.col("at").alias("depth"), "said", "size")
    heads = lent.join(convs.select("conv", "base", "taken"), "base").filter("depth <= taken").select("conv", "depth", "said", "size")
    lane = [F.xxhash64(F.lit(k), "depth", "said").alias(name) for k, name in enumerate("ab")]
    return convs.select("conv", "n_turns"), tails.unionByName(heads).select("conv", "depth", *lane, "size")


def _paths(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """Each conversation's path in bands: ``conv``, ``key``, ``sizes``, ``ends`` (no band follows).

    ``key`` is the band, the node that it hangs on and its nodes, all in big-endian
    bytes, so that the order of keys is a depth-first order.
    """
    band = F.shiftright(F.col("depth") - 1, BAND.bit_length() - 1).cast("int")
    rows = turns.groupBy("conv", band.alias("band")).agg(F.sort_array(F.collect_list(F.struct("depth", "a", "b", "size"))).alias("turns"), F.bit_xor("a").alias("xa"), F.bit_xor("b").alias("xb"))
    before = W.partitionBy("conv").orderBy("band").rowsBetween(W.unboundedPreceding, -1)
    hung = rows.select(
        "conv", "band", *[F.coalesce(F.bit_xor(x).over(before), F.lit(0)).alias(y) for x, y in (("xa", "ra"), ("xb", "rb"))],
        F.lead("band").over(W.partitionBy("conv").orderBy("band")).isNull().alias("ends"), "turns",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("turns")
            ends = np.asarray(lists.offsets).astype(np.int64)
            inner = lists.values
            start = ends[0]
            counts = np.diff(ends)
            nodes = np.empty((ends[-1] - start, 2), np.uint64)
            for k, (name, root) in enumerate((("a", "ra"), ("b", "rb"))):
                values = np.asarray(inner.field(name))[start : ends[-1]].view(np.uint64)
                running = np.bitwise_xor.accumulate(values) if len(values) else values
                offset = np.concatenate([[np.uint64(0)], running])[ends[:-1] - start] ^ np.asarray(batch.column(root)).view(np.uint64)
                nodes[:, k] = running ^ np.repeat(offset, counts)
            flat = nodes.astype(">u8").tobytes()
            bands, ra, rb = (np.asarray(batch.column(x)) for x in ("band", "ra", "rb"))
            top = np.zeros(len(bands), np.dtype([("band", ">u4"), ("a", ">u8"), ("b", ">u8")]))
            top["band"], top["a"], top["b"] = bands, ra.view(np.uint64), rb.view(np.uint64)
            top = top.tobytes()
            edges = ((ends - start) * NODE).tolist()
            keys = [top[HEADER * i : HEADER * (i + 1)] + flat[edges[i] : edges[i + 1]] for i in range(len(bands))]
            sizes = pa.ListArray.from_arrays(pa.array((ends - start).astype(np.int32)), inner.field("size").slice(start, ends[-1] - start))
            yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(keys, pa.binary()), sizes, batch.column("ends")], names=["conv", "key", "sizes", "ends"])

    found = hung.mapInArrow(run, "conv long, key binary, sizes array<bigint>, ends boolean")
    bare = convs.filter("n_turns = 0").select("conv", F.lit(bytes(HEADER)).alias("key"), F.array().cast("array<bigint>").alias("sizes"), F.lit(True).alias("ends"))
    return found.unionByName(bare)


def _lists(members: DataFrame) -> DataFrame:
    """``key`` and ``sha``: the digest of the ascending conversation ids of each key.

    A digest runs over its list from one end to the other, so a key's ids pass one task,
    sorted and in batches; only the state of the digest is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            keys, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[tuple[bytes, str]] = []
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if keys[a] != at:
                    if state is not None:
                        out.append((at, state.hexdigest()))
                    at, state = keys[a], hashlib.sha256()
                else:
                    state.update(b",")
                state.update(",".join(map(str, ids[a:b])).encode())
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([s for _, s in out], pa.string())], names=["key", "sha"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([state.hexdigest()])], names=["key", "sha"])

    return members.repartition("key").sortWithinPartitions("key", "conv").mapInArrow(run, "key binary, sha string")


ITEMS = ["key", "sizes", "n", "least", "last", "sha", "more_children", "more_leaves", "more_saved"]
PARTS = "node binary, depth long, parent binary, shared boolean, conv_id long, parent_conv_id long, parent_shared boolean, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _common(a: bytes | None, b: bytes | None) -> int:
    """How many nodes two paths share; -1 if they hang on different nodes."""
    if a is None or b is None or a[:HEADER] != b[:HEADER]:
        return -1
    short = min(len(a), len(b))
    x, y = np.frombuffer(a, np.uint32, (short - HEADER) // 4, HEADER), np.frombuffer(b, np.uint32, (short - HEADER) // 4, HEADER)
    differ = np.flatnonzero(x != y)
    return int(differ[0]) // 4 if len(differ) else (short - HEADER) // NODE


def shard_nodes(rows: dict[str, list], before: bytes | None, after: bytes | None) -> dict[str, list | np.ndarray]:
    """Nodes of one shard; ``before`` and ``after`` are the keys next to it.

    Each node's numbers count what this shard holds.  A node shared with the shard
    before it, its own leaf and its bytes are counted there.
    """
    order = sorted(range(len(rows["key"])), key=rows["key"].__getitem__)
    keys = [rows["key"][i] for i in order]
    n_items = len(keys)
    length = np.array([(len(k) - HEADER) // NODE for k in keys])
    common = np.array([-1, *(_common(a, b) for a, b in zip(keys, keys[1:], strict=False))])
    # A path opens its nodes behind the common ones; with another band or root, also a local root (height 0).
    opened = length - common
    closed = np.concatenate([opened[:0], length[:-1] - common[1:], [length[-1] + 1]]).astype(np.int64)
    runs = np.stack([opened, closed], axis=1).ravel()
    parens = Parens(np.repeat(np.tile([True, False], n_items), runs))
    at = np.flatnonzero(parens.opens)
    n_nodes = len(at)
    close = parens.find_close(at)
    item = np.repeat(np.arange(n_items), opened)
    height = parens.excess[at] - 1
    # Nodes are numbered as they open; the last one that a path has is its end.
    end = np.cumsum(opened) - 1
    subtree = np.searchsorted(at, close)  # one past the last node below

    def column(name: str, kind: type = np.int64) -> np.ndarray:
        return np.array([rows[name][i] for i in order], kind)

    size = np.zeros(n_nodes, np.int64)
    flat = np.concatenate([np.asarray(rows["sizes"][i], np.int64) for i in order]) if n_items else np.zeros(0, np.int64)
    within = height > 0
    starts = np.concatenate([[0], np.cumsum(length)])
    size[within] = flat[starts[item[within]] + height[within] - 1]
    first, final = _common(before, keys[0]), _common(keys[-1], after)
    new = np.ones(n_nodes, bool)
    new[: first + 1] = False  # the first path opens its nodes from the root down
    shared = ~new
    if final >= 0:
        spine = _spine(parens, at, height, end[-1], final)
        shared[spine] = True
    # Members: paths that end in the subtree.
    ends_here = np.zeros(n_nodes, np.int64)
    ends_here[end] = column("n")
    cumulative = np.concatenate([[0], np.cumsum(ends_here)])
    members = cumulative[subtree] - cumulative[:-1]
    # Leaf pairs, less those whose path another shard or band continues.
    pairs = parens.opens[:-1] & ~parens.opens[1:]
    leaf = pairs[at] & (height >= 0)
    more = {x: column(x) for x in ("more_children", "more_leaves", "more_saved")}
    continued = column("last", bool) == False  # noqa: E712
    leaf[end[continued]] = False
    if final == length[-1]:
        leaf[end[-1]] = False
    leaves = leaf.astype(np.int64)
    np.add.at(leaves, end, more["more_leaves"])
    ranks = np.concatenate([[0], np.cumsum(leaves)])
    # Savings: members times bytes, less once the bytes of each node.
    saved = members * size - np.where(new, size, 0)
    np.add.at(saved, end, more["more_saved"])
    sums = np.concatenate([[0], np.cumsum(saved)])
    parent = np.full(n_nodes, -1)
    least = np.full(n_nodes, np.iinfo(np.int64).max)
    least[end] = column("least")
    deepest = int(height.max()) if n_nodes else 0
    levels = [np.flatnonzero(height == h) for h in range(deepest + 1)]
    for h in range(1, deepest + 1):
        parent[levels[h]] = levels[h - 1][np.searchsorted(levels[h - 1], levels[h], "right") - 1]
    for h in range(deepest, 0, -1):
        np.minimum.at(least, parent[levels[h]], least[levels[h]])
    children = np.zeros(n_nodes, np.int64)
    np.add.at(children, parent[within & new], 1)
    np.add.at(children, end, more["more_children"])
    names = [keys[i][HEADER + NODE * (h - 1) : HEADER + NODE * h] if h else keys[i][4:HEADER] for i, h in zip(item.tolist(), height.tolist(), strict=True)]
    bands = np.array([int.from_bytes(k[:4]) for k in keys], np.int64)[item]
    sha: list[str | None] = [None] * n_nodes
    for e, i in zip(end.tolist(), order, strict=True):
        sha[e] = rows["sha"][i]
    up = parent.tolist()
    return {
        "node": names, "depth": bands * BAND + height, "parent": [names[p] if p >= 0 else None for p in up], "shared": shared, "conv_id": least,
        "parent_conv_id": [int(least[p]) if p >= 0 else None for p in up], "parent_shared": np.where(parent >= 0, shared[parent], False),
        "n_convs": members, "n_children": children, "n_leaves": ranks[subtree] - ranks[:-1], "saved_tokens": sums[subtree] - sums[:-1], "ends_sha256": sha,
        "height": height,
    }


def _spine(parens: Parens, at: np.ndarray, height: np.ndarray, last: int, final: int) -> np.ndarray:
    """The last nodes of heights 0 to ``final``: they lead to the last path's end."""
    out, want = [], final
    for i in range(last, -1, -1):
        if height[i] <= want:
            want = int(height[i])
            out.append(i)
            want -= 1
            if want < 0:
                break
    return np.array(out)


def _shards(items: DataFrame, turns: int, local_roots: bool) -> DataFrame:
    """Nodes of all shards in their parts: of the local roots alone, or of all but those below the first band."""
    parts = max(1, -(-turns // SHARD_TURNS))
    ranged = cut(items.repartitionByRange(parts, "key").withColumn("shard", F.spark_partition_id()))
    bounds = ranged.groupBy("shard").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    # One row a shard, by shard number.
    order = W.orderBy("shard")
    near = bounds.select("shard", F.lag("high").over(order).alias("before"), F.lead("low").over(order).alias("after"))
    joined = ranged.join(near, "shard")

    def run(table: pa.Table) -> pa.Table:
        rows = {x: table.column(x).to_pylist() for x in ITEMS}
        found = shard_nodes(rows, table.column("before")[0].as_py(), table.column("after")[0].as_py())
        height = found.pop("height")
        keep = (height == 0) == local_roots
        if not local_roots:
            keep |= np.asarray(found["depth"]) == 0
        types = [pa.binary(), pa.int64(), pa.binary(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 4, pa.string()]
        return pa.table([pa.array(v, t) for v, t in zip(found.values(), types, strict=True)], names=list(found)).filter(pa.array(keep))

    return joined.groupBy("shard").applyInArrow(run, PARTS)


def _below(items: DataFrame, turns: int) -> DataFrame:
    """``node``, ``depth`` and what hangs below it in later bands: children, leaves, savings.

    Local sums of the bands are added up along the bands above by doubling: a round
    takes each band twice as far, so rounds grow with the logarithm of their number.
    """
    roots = _shards(items.filter(F.substring("key", 1, 4) > F.lit(bytes(4))), turns, True).groupBy("node", "depth").agg(*[F.sum(x).alias(x) for x in ("n_children", "n_leaves", "saved_tokens")])
    # The node that a band hangs on ends a path of the band above.
    above = items.filter("not last").select(F.expr(f"substring(key, length(key) - {NODE - 1}, {NODE})").alias("node"), ((F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long") + 1) * BAND).alias("depth"), F.expr(f"substring(key, 5, {NODE})").alias("up")).distinct()
    now = cut(roots.join(above, ["node", "depth"]).withColumn("jump", F.lit(BAND).cast("long")))
    while not now.filter("depth - jump > 0").isEmpty():
        to = now.select("node", "depth", F.col("up").alias("next"))
        gained = now.filter("depth - jump > 0").groupBy(F.col("up").alias("node"), (F.col("depth") - F.col("jump")).alias("depth")).agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        moved = now.join(gained, ["node", "depth"], "left").withColumn("n_leaves", F.col("n_leaves") + F.coalesce("l", F.lit(0))).withColumn("saved_tokens", F.col("saved_tokens") + F.coalesce("s", F.lit(0))).drop("l", "s")
        lead = to.select(F.col("node").alias("up"), (F.col("depth")).alias("at"), "next")
        moved = moved.withColumn("at", F.col("depth") - F.col("jump")).join(lead, ["up", "at"], "left")
        now = cut(moved.select("node", "depth", "n_children", "n_leaves", "saved_tokens", F.coalesce("next", "up").alias("up"), (F.col("jump") * 2).alias("jump")))
    return now.select("node", "depth", "n_children", "n_leaves", "saved_tokens")


def nodes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """All nodes of the trie of the given paths: see ``digests`` for the columns; ``node`` is 16 bytes.

    ``convs`` has ``conv`` and ``n_turns``, ``turns`` has ``conv``, ``depth`` from 1, two
    lanes ``a`` and ``b`` that tell what is said at that depth, and ``size``.
    """
    members = cut(_paths(convs, turns))
    grouped = members.groupBy("key").agg(
        F.first("sizes").alias("sizes"), F.count("*").alias("n"), F.min("conv").alias("least"), F.bool_and("ends").alias("last"),
        F.count_if("ends").alias("n_ends"), F.min(F.when(F.col("ends"), F.col("conv"))).alias("end"),
    )
    shared = grouped.filter("n_ends > 1").select("key")
    several = _lists(members.filter("ends").join(shared, "key", "left_semi").select("key", "conv"))
    sha = F.when(F.col("n_ends") == 1, F.sha2(F.col("end").cast("string").cast("binary"), 256)).when(F.col("n_ends") > 1, F.col("sha"))
    plain = cut(grouped.join(several, "key", "left").select("key", "sizes", "n", "least", "last", sha.alias("sha")))
    total, deep = plain.agg(F.sum(F.size("sizes") + 1), F.max(F.size("sizes") == BAND)).first()
    items = plain.select("*", *[F.lit(0).cast("long").alias(x) for x in ITEMS[-3:]])
    total = total or 0
    if deep:
        below = _below(items, total).select(
            F.col("node").alias("bnode"), F.col("depth").alias("bdepth"), F.col("n_children").alias("more_children"), F.col("n_leaves").alias("more_leaves"), F.col("saved_tokens").alias("more_saved")
        )
        named = plain.withColumn("bnode", F.expr(f"substring(key, length(key) - {NODE - 1}, {NODE})")).withColumn("bdepth", F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long") * BAND + F.size("sizes"))
        named = named.join(below, ["bnode", "bdepth"], "left").drop("bnode", "bdepth")
        items = named.fillna(0, ["more_children", "more_leaves", "more_saved"]).select(*ITEMS)
    parts = cut(_shards(items, total, False))
    merged = cut(
        parts.filter("shared").groupBy("node", "depth").agg(
            F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"), *[F.sum(x).alias(x) for x in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.max("ends_sha256").alias("ends_sha256")
        )
    )
    whole = parts.filter("not shared").select("node", "depth", "parent", "conv_id", "parent_conv_id", "parent_shared", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    spines = merged.withColumn("parent_conv_id", F.lit(None).cast("long")).withColumn("parent_shared", F.col("depth") > 0)
    every = whole.unionByName(spines)
    # The parent of a node in a later band stands in the band above, like one on a spine it may be another shard's.
    sought = F.col("parent_shared") | ((F.col("depth") > 1) & (F.col("depth") % BAND == 1))
    known = every.filter(~sought)
    open_ = every.filter(sought).drop("parent_conv_id").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
    tops = merged.select("node", "depth", "conv_id").unionByName(whole.filter(F.col("depth") % BAND == 0).select("node", "depth", "conv_id"))
    tops = tops.select(F.col("node").alias("parent"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    answered = open_.join(tops, ["parent", "depth", "salt"], "left")
    return known.unionByName(answered.drop("salt")).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))


def digests(conversations: DataFrame) -> DataFrame:
    """Per node of the trie of rebuilt conversations: smallest member, depth, parent's smallest member, counts and savings.

    An empty table has no node, not even a root.
    """
    found = nodes(*rebuild(conversations))
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


SQL = """
with t as (select conv_id as c, coalesce(role, '') as r, coalesce(text, '') as x, row_number() over (partition by conv_id order by turn nulls first, role, text) as at from conversations where conv_id is not null),
n as (select c, count(*) as n, c - c % 5 as b, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::varchar, ''), lambda y: ascii(y)::bigint)),
  lambda v, y: list_reduce([xor(v, y), 0, 0, 0, 0, 0, 0, 0, 0], lambda w, z: case when w & 1 = 1 then xor(w >> 1, 3988292384) else w >> 1 end)), 4294967295) % 9 as h from t group by c),
k as (select n.*, least(n.h, coalesce(m.n, 0)) as taken from n left join n m on m.c = n.b),
turns as (select k.c, t.at as d, t.r, t.x from k join t on t.c = k.b and t.at <= k.taken
 union all select k.c, t.at - k.h + k.taken, t.r, t.x from k join t on t.c = k.c and t.at > k.h),
paths as (select c, d, strlen(x) as size, string_agg(md5(strlen(r) || ':' || r || x), '') over (partition by c order by d) as p from turns union all select c, 0, 0, '' from n),
nodes as (select p, d, min(c) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(size) as own from paths group by p, d),
links as (select u.d, u.p, left(u.p, 32 * (u.d - 1)) as up from nodes u where u.d > 0),
children as (select up, count(*) as n from links group by up),
below as (select left(u.p, 32 * i.i) as p, sum(case when h.n is null then 1 else 0 end) as n_leaves, sum(u.own) as saved
 from (select p, own, unnest(range(0, d + 1)) as i from nodes) u(p, own, i), (select u.i) i left join children h on h.up = u.p group by 1),
ends as (select p, sha256(string_agg(c::varchar, ',' order by c)) as s from (select c, p from paths qualify row_number() over (partition by c order by d desc) = 1) group by p)
select u.conv_id, u.d as depth, v.conv_id as parent_conv_id, u.n_convs, coalesce(h.n, 0) as n_children, b.n_leaves::bigint as n_leaves, b.saved::bigint as saved_tokens, coalesce(e.s, sha256('')) as ends_sha256
from nodes u left join nodes v on u.d > 0 and v.d = u.d - 1 and v.p = left(u.p, 32 * (u.d - 1)) left join children h on h.up = u.p join below b on b.p = u.p left join ends e on e.p = u.p
"""
