"""A prefix trie of conversations as a burst trie: containers of suffixes under heads, burst while oversized, then swept."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_kept, stored

#: A container of more sequences than this and than 1 / SHARES of all bursts, so there are at most SHARES times as many
#: heads as levels; the driver holds one small row for each.
CONTAINER, SHARES = 256, 4096
#: Ids of one block of the lists of ends.
BLOCK_BITS = 10
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, k1 long, k2 long"


def turn_sequences(rows: DataFrame) -> DataFrame:
    """(conv_id, ids, sizes): each conversation's turns in order as two 64-bit numbers a turn, and bytes of each text.

    Order: by turn (null first), then role, then digest. Null role or text is empty; rows of no conversation (null
    conv_id) are left out."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(11), role, text).alias("h2"), F.octet_length(text).cast("long").alias("size")).alias("t"),
    )
    got = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return got.select("conv_id", F.flatten(F.transform("t", lambda x: F.array(x["h1"], x["h2"]))).alias("ids"), F.col("t.size").alias("sizes"))


def rebuilt(sequences: DataFrame, group: int = 5, span: int = 9) -> DataFrame:
    """Each conversation c again: the first h turns of conversation c - c % group, then its own after its first h, with
    h = crc32(decimal c) % span. Without the other conversation only the own turns after the first h stay."""
    c = F.col("conv_id")
    s = sequences.withColumns({"h": (F.crc32(c.cast("string").cast("binary")) % span).cast("int"), "base": c - c % group})
    most = span - 1
    bases = s.where(c % group == 0).select(c.alias("base"), F.slice("ids", 1, 2 * most).alias("base_ids"), F.slice("sizes", 1, most).alias("base_sizes"))
    j = s.join(bases, "base", "left")

    def spliced(own: str, other: str, width: int) -> Column:
        n = F.col("h") * width
        head = F.coalesce(F.slice(other, F.lit(1), n), F.array().cast("array<bigint>"))
        return F.concat(head, F.slice(own, n + 1, F.greatest(F.size(own) - n, F.lit(0)))).alias(own)

    return j.select("conv_id", spliced("ids", "base_ids", 2), spliced("sizes", "base_sizes", 1))


def distinct_sequences(sequences: DataFrame) -> DataFrame:
    """(k1, k2, ids, sizes, n, conv): equal sequences once, with their number and least conv_id."""
    g = sequences.groupBy("k1", "k2").agg(F.first("ids").alias("ids"), F.first("sizes").alias("sizes"), F.count("*").alias("n"), F.min("conv_id").alias("conv"))
    return g.select("k1", "k2", "ids", "sizes", "n", "conv")


# --- bursting ----------------------------------------------------------------------------------------------------


def common_turns(a: Column, b: Column) -> Column:
    """Whole turns that two lists of ids begin with in common."""
    start = lambda x: F.slice(x, F.lit(1), F.least(F.size(a), F.size(b)))
    differs = F.array_position(F.zip_with(start(a), start(b), lambda x, y: x != y), True)
    return F.floor(F.when(differs == 0, F.least(F.size(a), F.size(b))).otherwise(differs - 1) / 2).cast("int")


def burst(sequences: DataFrame, container: int = CONTAINER) -> tuple[DataFrame, list[dict]]:
    """(settled, heads): containers of at most `container` sequences (or 1 / SHARES of all) under the heads above them.

    In each round the containers under open heads are counted by their next turn's id. Small ones settle. A large one
    becomes a head itself; the turns that all its sequences go on with are skipped, so each round splits what it bursts,
    and rounds end after as many as there are branchings on a path of large containers. settled: the sequences with
    `head`, `head_conv` (its least conv_id) and `depth` (turns that the head stands for). heads, on the driver: number,
    parent, top and depth (first and last depth of the skipped run), n, conv, k1 and k2 of the sequence that ends there,
    children, and the bytes of the texts from top to depth."""
    spark = sequences.sparkSession
    total = sequences.count()
    limit = max(container, total // SHARES)
    root = sequences.agg(F.sum("n"), F.min("conv")).first()
    if not total:
        return sequences.select("*", F.lit(0).alias("head"), F.lit(0).cast("long").alias("head_conv"), F.lit(0).alias("depth")), []
    heads = [{"head": 0, "parent": None, "top": 0, "depth": 0, "n": root[0], "conv": root[1], "sizes": [0], "k1": None, "k2": None, "children": 0}]
    now, settled = sequences.select("*", F.lit(0).alias("head"), F.lit(root[1]).alias("head_conv"), F.lit(0).alias("depth")), None
    while True:
        at = 2 * F.col("depth")
        now = now.withColumns({"x1": F.try_element_at("ids", at + 1), "x2": F.try_element_at("ids", at + 2)})
        counts = stored(now.groupBy("head", "x1", "x2").agg(F.count("*").alias("rows"), F.sum("n").alias("n"), F.min("conv").alias("conv"), F.max("k1").alias("k1"), F.max("k2").alias("k2")), "containers")
        ended = F.col("x1").isNull()
        ends = lambda c: F.max(F.when(ended, F.col(c))).alias(c)  # noqa: E731  a sequence of each is all that can end at a head
        for r in counts.groupBy("head").agg(F.count_if(~ended).alias("children"), ends("k1"), ends("k2")).collect():  # a row for each open head
            heads[r["head"]] |= {"children": r.children, "k1": r.k1, "k2": r.k2}
        large = counts.where(~ended & (F.col("rows") > limit)).collect()  # SHARES at most
        if not large:
            rest = now.where(~ended)
            break
        new = [{"head": len(heads) + i, "parent": r["head"], "n": r.n, "conv": r.conv, "k1": None, "k2": None, "children": 0} for i, r in enumerate(large)]
        named = spark.createDataFrame([(r["head"], r.x1, r.x2, h["head"], r.conv) for r, h in zip(large, new, strict=True)], "head int, x1 long, x2 long, new_head int, new_conv long")
        marked = stored(now.join(F.broadcast(named), ["head", "x1", "x2"], "left").select(*now.columns, "new_head", "new_conv"), "burst")
        small = marked.where(~ended & F.col("new_head").isNull()).drop("new_head", "new_conv", "x1", "x2")
        settled = small if settled is None else settled.union(small)
        opened = marked.where("new_head is not null")
        bounds = opened.groupBy("new_head").agg(F.min("ids").alias("a"), F.max("ids").alias("z"), F.min(F.struct("ids", "sizes"))["sizes"].alias("sizes"), F.min("depth").alias("was"))
        skips = bounds.select("new_head", "was", common_turns(F.col("a"), F.col("z")).alias("to"), "sizes")
        skips = skips.select("new_head", "was", "to", F.slice("sizes", F.col("was") + 1, F.col("to") - F.col("was")).alias("sizes"))
        to = {r.new_head: r for r in skips.collect()}
        for h in new:
            r = to[h["head"]]
            h |= {"top": r.was + 1, "depth": r.to, "sizes": r.sizes}
        heads += new
        deeper = spark.createDataFrame([(h["head"], h["depth"]) for h in new], "new_head int, new_depth int")
        now = opened.join(F.broadcast(deeper), "new_head").select(*sequences.columns, F.col("new_head").alias("head"), F.col("new_conv").alias("head_conv"), F.col("new_depth").alias("depth"))
    rest = rest.drop("x1", "x2")
    return (rest if settled is None else settled.union(rest)), heads


# --- sweeping ----------------------------------------------------------------------------------------------------


class Sweep:
    """Nodes from sequences in order: a stack of the nodes on the way to the last one; a node closes when a sequence
    leaves it. Children wait for their parent, whose least conv_id is their parent_conv_id."""

    def __init__(self) -> None:
        self.stack: list[list] = []
        self.ids = np.zeros(0, np.int64)
        self.under: tuple[int, int, int] | None = None  # head, its conv, its depth
        self.out: list[tuple] = []

    def leave(self, depth: int) -> None:
        """Close the nodes deeper than depth."""
        while self.stack and self.stack[-1][0] > depth:
            d, size, n, conv, children, leaves, saved, k1, k2, waiting = self.stack.pop()
            leaves, saved = leaves or 1, saved + (n - 1) * size
            self.out += [(*row[:2], conv, *row[3:], None) for row in waiting]
            row = (conv, d, None, n, children, leaves, saved, k1, k2)
            if self.stack:
                up = self.stack[-1]
                up[2] += n
                up[3] = conv if up[3] is None else min(up[3], conv)
                up[4] += 1
                up[5] += leaves
                up[6] += saved
                up[9].append(row)
            else:
                head, head_conv, _ = self.under
                self.out.append((*row[:2], head_conv, *row[3:], head))

    def add(self, head: int, head_conv: int, depth: int, ids: np.ndarray, sizes: np.ndarray, n: int, conv: int, k1: int, k2: int) -> None:
        same = depth
        if self.under == (head, head_conv, depth):
            m = min(len(ids), len(self.ids))
            differs = np.flatnonzero(ids[:m] != self.ids[:m])
            same = max(depth, (int(differs[0]) if len(differs) else m) // 2)
            self.leave(same)
        else:
            self.leave(-1)
        self.under, self.ids = (head, head_conv, depth), ids
        for d, size in enumerate(sizes[same:].tolist(), same + 1):
            self.stack.append([d, size, 0, None, 0, 0, 0, None, None, []])
        last = self.stack[-1]
        last[2] += n
        last[3] = conv if last[3] is None else min(last[3], conv)
        last[7], last[8] = k1, k2


def sweep(settled: DataFrame) -> DataFrame:
    """Nodes (NODE) of all containers, with `head` where a node stands directly under one. A container's sequences come
    to one task in order and are swept in one pass."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        s = Sweep()
        schema = pa.schema([(x.split()[0], pa.int64()) for x in f"{NODE}, head long".split(", ")])
        take = lambda: pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*s.out, strict=True)] if s.out else [pa.array([], pa.int64())] * len(schema), schema=schema)
        for b in batches:
            ids, sizes = b["ids"], b["sizes"]
            i, j = ids.offsets.to_numpy(), sizes.offsets.to_numpy()
            flat, width = ids.values.to_numpy(), sizes.values.to_numpy()
            rest = [b[n].to_pylist() for n in ("head", "head_conv", "depth", "n", "conv", "k1", "k2")]
            for r, (head, head_conv, depth, n, conv, k1, k2) in enumerate(zip(*rest, strict=True)):
                s.add(head, head_conv, depth, flat[i[r] : i[r + 1]], width[j[r] : j[r + 1]], n, conv, k1, k2)
            yield take()
            s.out = []
        s.leave(-1)
        yield take()

    at = 2 * F.col("depth")
    by = settled.withColumn("x", F.element_at("ids", at + 1)).repartition("head", "x").sortWithinPartitions("head", "ids").drop("x")
    return by.mapInArrow(nodes, f"{NODE}, head long")


def head_nodes(heads: list[dict], totals: dict[int, tuple[int, int]], spark) -> DataFrame:
    """Nodes of the heads and of the runs skipped above them. totals: leaves and saved of the containers under each."""
    below: dict[int, list[int]] = {h["head"]: list(totals.get(h["head"], (0, 0))) for h in heads}
    for h in reversed(heads):  # a head's number is larger than its parent's
        own = below[h["head"]]
        if not h["children"]:
            own[0] = 1
        if h["parent"] is not None:
            up = below[h["parent"]]
            up[0] += own[0]
            up[1] += own[1] + (h["n"] - 1) * sum(h["sizes"])
    rows = [(h["head"], h["n"], h["conv"], heads[h["parent"]]["conv"] if h["parent"] is not None else None, h["children"], *below[h["head"]], h["top"], list(accumulate(reversed(h["sizes"])))[::-1], h["k1"], h["k2"]) for h in heads]
    t = spark.createDataFrame(rows, "head int, n long, conv long, up long, children long, leaves long, saved long, top int, from_here array<long>, k1 long, k2 long")
    e = t.select("*", F.posexplode("from_here").alias("i", "bytes"))
    last = F.col("i") == F.size("from_here") - 1
    one = lambda c: F.when(last, F.col(c))
    return e.select(
        F.col("conv").alias("conv_id"), (F.col("top") + F.col("i")).cast("long").alias("depth"), F.when(F.col("i") == 0, F.col("up")).otherwise(F.col("conv")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(last, F.col("children")).otherwise(1).alias("n_children"), F.col("leaves").alias("n_leaves"), (F.col("saved") + (F.col("n") - 1) * F.col("bytes")).alias("saved_tokens"), one("k1").alias("k1"), one("k2").alias("k2"),
    )


def end_digests(members: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of members (conv_id, k1, k2): lowercase SHA-256 of decimal conv_ids, ascending, with commas.

    Ids are joined in blocks of 2**BLOCK_BITS numbers; a sequence's blocks are then streamed in order, so that of many
    members of one sequence no list is held."""
    blocks = members.groupBy("k1", "k2", F.shiftright("conv_id", BLOCK_BITS).alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("c"))
    blocks = blocks.select("k1", "k2", "block", F.array_join(F.transform("c", lambda x: x.cast("string")), ",").alias("c"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, out = None, None, []
        schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])
        for b in batches:
            for k1, k2, ids in zip(*(b[n].to_pylist() for n in ("k1", "k2", "c")), strict=True):
                if (k1, k2) == key:
                    sha.update(b"," + ids.encode())
                    continue
                out += [(*key, sha.hexdigest())] if key else []
                key, sha = (k1, k2), hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in out], schema)
            out = []
        if key:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*key, sha.hexdigest()), strict=True))], schema)

    return blocks.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "block").mapInArrow(digest, "k1 long, k2 long, ends_sha256 string")


def prefix_nodes(sequences: DataFrame, container: int = CONTAINER) -> DataFrame:
    """One row per distinct sequence of the first d turns of a conversation, the textless root (d = 0) among them.

    sequences: conv_id, ids, sizes (one row per conversation). Returns conv_id (the smallest member), depth,
    parent_conv_id (the parent's conv_id, null for the root), n_convs (members), n_children, n_leaves (childless nodes in
    its subtree), saved_tokens (over its subtree each node's n_convs - 1 times the bytes of its last text), ends_sha256
    (of the members that end there; the empty string's if none do). Turns are compared by 128 bits of role and text.

    Equal sequences count as one with its members, however many. A conversation without turns is a member of the root;
    an empty table gives no node. A conversation's ids (16 bytes a turn) are held at once, its texts never."""
    keyed = sequences.select("conv_id", "ids", "sizes", F.xxhash64("ids").alias("k1"), F.xxhash64(F.lit(5), "ids").alias("k2"))
    keyed = stored(keyed, "sequences")
    settled, heads = burst(stored(distinct_sequences(keyed), "distinct"), container)
    spark = sequences.sparkSession
    swept = stored(sweep(settled), "nodes")
    totals = {r["head"]: (r.leaves, r.saved) for r in swept.where("head is not null").groupBy("head").agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")).collect()}  # a row for each head
    nodes = swept.drop("head").unionByName(head_nodes(heads, totals, spark))
    ends = end_digests(keyed.select("conv_id", "k1", "k2"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    none = nodes.where("k1 is null").select(*columns, F.lit(hashlib.sha256().hexdigest()).alias("ends_sha256"))
    return nodes.where("k1 is not null").join(ends, ["k1", "k2"]).select(*columns, "ends_sha256").union(none)


def conversation_trie(conversations: DataFrame, container: int = CONTAINER) -> DataFrame:
    """prefix_nodes() of rebuilt conversations of (conv_id, turn, role, text); see turn_sequences() and rebuilt() for
    order, nulls and ties. Repeated rows are turns of their own."""
    return prefix_nodes(rebuilt(turn_sequences(conversations)), container)
