"""Exact Jaccard join of word-shingle sets with set-relation skipping.

Candidates come from a prefix filter whose order puts rare shingles first, so a passage that many documents share
makes no candidates unless it is most of a document. Candidates fall into clusters, large clusters into blocks of like
size that share rare shingles, and only blocks that meet in an index list are compared. Within a task the lists are
ordered by set size: sets of like size are taken together, and of each list only the positions that can link with them
are visited, the blocks before and behind are skipped. A set's overlaps are derived from those of the set before it,
which is very similar, by visiting only the lists of the shingles that differ."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import common_keys, components, drop_kept, forget, in_share, join_counted, join_small, keys_met_again, shingle_sets, stored, unique_documents
from .itq_neardup import merged

#: Of 8 hash values, those whose shingles are counted over the corpus; documents of one block of a cluster.
COUNTED, BLOCK = 3, 512


def prefix_length(n: int, percent: int = 75) -> int:
    """Elements of a set of n of which any linking set shares at least one: n minus the least overlap, plus 1."""
    return n - -(-percent * n // 100) + 1


def low_shingles(shingles: np.ndarray, cut: np.uint64, percent: int) -> np.ndarray:
    """The sorted shingles below the cut, and as many above it as the prefix needs."""
    below = int(np.searchsorted(shingles, cut))
    return shingles[: max(below, prefix_length(len(shingles), percent))] if len(shingles) else shingles


def set_rows(docs: DataFrame, cut: np.uint64, percent: int) -> DataFrame:
    """(doc_id, n, shingles below the cut, digest of the whole set, low shingles) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                b = whole.slice(k, 1000)
                texts = [t or b"" for t in b.column(1).to_pylist()]
                n, below, digest, low, sizes = [], [], [], [], [0]
                for s in shingle_sets(texts):
                    n.append(len(s))
                    below.append(int(np.searchsorted(s, cut)))
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    low.append(low_shingles(s, cut, percent).view(np.int64))
                    sizes.append(sizes[-1] + len(low[-1]))
                lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(low) if low else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(below, pa.int64()), pa.array(digest, pa.binary()), lists], ["doc_id", "n", "below", "digest", "low"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, n long, below long, digest binary, low array<long>")


def size_bands(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Bands of set sizes: sets whose bands differ by two or more can't link."""
    return np.floor(np.log(np.maximum(sizes, 1)) / np.log(100 / percent) + 1e-9).astype(np.int64)


def linked_pairs(sets: list[np.ndarray], group: np.ndarray, percent: int = 75) -> Iterator[tuple[int, np.ndarray]]:
    """(i, indices j that link with set i), for sets in ascending size; j > i in group 1, or j of the other group.

    group: all 1 compares each pair of sets once; else only sets of groups 0 and 1 are compared with each other."""
    count = len(sets)
    sizes = np.array([len(s) for s in sets])
    values, ids = np.unique(np.concatenate(sets), return_inverse=True)
    keyed = np.sort(ids * count + np.repeat(np.arange(count), sizes))  # lists one after another, each by position
    lists, df = keyed % count, np.bincount(ids, minlength=len(values))
    split = np.concatenate(([0], np.cumsum(sizes)))
    own = [np.sort(ids[split[i] : split[i + 1]]) for i in range(count)]
    rare = df < 2  # lists of one set are of no use
    own = [e[~rare[e]] for e in own]
    # sets of one band together; in it similar sets next to each other: by their commonest elements
    band = size_bands(sizes, percent)
    lead = np.lexsort((sizes, [hash(e[np.argsort(-df[e], kind="stable")[:12]].tobytes()) if len(e) else 0 for e in own], band))
    crossing = group.min() != group.max()
    overlap, last, here, low, high = np.zeros(count, np.int64), None, -1, 0, 0

    def visit(elements: np.ndarray, by: int) -> None:
        """Count the sets at positions low to high of the elements' lists; what stands outside is skipped."""
        if len(elements):
            a, z = np.searchsorted(keyed, elements * count + low), np.searchsorted(keyed, elements * count + high)
            n = z - a
            at = np.repeat(a - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(int(n.sum()))
            overlap[low:high] += by * np.bincount(lists[at] - low, minlength=high - low)

    for i in lead:
        mine = own[i]
        if band[i] != here:
            # the smaller sets of a pair look for the larger ones: from this band's first to the largest that can link
            here, last = band[i], None
            most = sizes[np.searchsorted(band, here, side="right") - 1]
            low, high = int(np.searchsorted(band, here)), int(np.searchsorted(sizes, 100 * most // percent, side="right"))
            overlap[:] = 0
        gone, new = (mine[:0], mine) if last is None else (np.setdiff1d(last, mine, True), np.setdiff1d(mine, last, True))
        if last is not None and len(gone) + len(new) >= len(mine):
            overlap[:] = 0
            gone, new = mine[:0], mine
        visit(gone, -1)
        visit(new, 1)
        last = mine
        a, z = i + 1, int(np.searchsorted(sizes, 100 * sizes[i] // percent, side="right"))
        if a < z:
            o = overlap[a:z]
            hit = np.flatnonzero(100 * o >= percent * (sizes[i] + sizes[a:z] - o)) + a
            if crossing:
                hit = hit[group[hit] != group[i]]
            if len(hit):
                yield int(i), hit


def forest(ids: np.ndarray, sets: list[np.ndarray], group: np.ndarray, percent: int) -> pd.DataFrame:
    """Edges from each linked document to the smallest document of its component within the block."""
    by_id = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), np.int64)
    rank[by_id] = np.arange(len(ids))
    size = np.argsort([len(s) for s in sets], kind="stable")
    left, right, links = [], [], np.zeros(len(ids), np.int64)
    for i, js in linked_pairs([sets[k] for k in size], group[size], percent):
        left.append(np.full(len(js), rank[size[i]]))
        right.append(rank[size[js]])
        links[size[i]] += len(js)
        np.add.at(links, size[js], 1)
        if len(left) > 256:
            root = merged(len(ids), np.concatenate(left), np.concatenate(right))
            left, right = [np.arange(len(ids))], [root]
    root = merged(len(ids), np.concatenate(left), np.concatenate(right)) if left else np.arange(len(ids))
    out = pd.DataFrame({"u": ids, "v": ids[by_id][root[rank]], "links": links})
    return out[out["links"] > 0]


def jaccard_components(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, counted: int = COUNTED) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for every document; links are exact.

    Two documents link when 100 * intersection >= percent * union of their five-word shingle sets; component_id is
    the smallest doc_id reachable by links. n_links counts distinct other sets linked directly (copies with equal
    sets count once and in the component). Null, empty or wordless texts have no shingles and link with nothing.
    Rows that share a doc_id count as one document (its smallest text); rows without doc_id are returned with their
    own n_shingles and a null component.

    Stages: equal sets are merged by digest; shingles below a hash cut (counted of 8 values) are counted over all
    distinct sets and ordered by count, so the prefix filter is exact and rare shingles come first; sets that share a
    prefix shingle form clusters (components over stars of the lists, no pairs); a cluster is compared in one task, or
    if it has more than `block` sets, in pairs of blocks that share a list. Tasks return spanning forests only."""
    keyed = unique_documents(docs, id_col, text_col)
    cut = np.uint64(counted << 61)
    sets = stored(set_rows(keyed, cut, percent), "sets")
    # only digests that occur again need a look-up
    reps = stored(sets.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")).where("copies > 1"), "reps")
    member = join_counted(sets.select("doc_id", "n", "digest"), reps, "digest", "copies", "left")
    member = stored(member.select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep")), "members")
    copies = member.where("doc_id <> rep").select("doc_id")
    kept = join_small(sets.where("n > 0").select("doc_id", "n", "low"), copies, "doc_id", "left_anti", copies.count())
    each = kept.select("doc_id", F.explode("low").alias("h"))
    each = keys_met_again(each, "h", "doc_id", common_keys(each.where(in_share("doc_id")), "h"))
    # order: counted shingles by (df, hash), then the others by hash; those of df 1 come first and match nothing
    limit = int(cut)
    counted_first = F.when((F.col("h") >= 0) & (F.col("h") < limit), F.col("df")).otherwise(F.lit(1 << 40))
    shared = each.withColumn("order", F.struct(counted_first.alias("df"), F.when(F.col("h") < 0, 1).otherwise(0).alias("top"), "h"))
    shared = stored(shared.groupBy("doc_id").agg(F.array_sort(F.collect_list("order")).alias("shared")), "shared")
    p = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1
    # of the low shingles, those of df 1: counted ones come before all, others stand between
    placed = sets.select("doc_id", "n", "below").join(shared, "doc_id")
    alone = F.col("below") - F.size(F.filter("shared", lambda s: s["df"] < (1 << 40)))
    placed = placed.select("doc_id", "n", "below", "shared", alone.alias("alone"), p.cast("int").alias("p"))
    # with too few counted shingles the prefix takes all low ones; they are as many as it needs
    taken = F.when(F.col("below") >= F.col("p"), F.slice("shared", 1, F.greatest(F.lit(0), F.col("p") - F.col("alone")))).otherwise(F.col("shared"))
    prefix = stored(placed.select("doc_id", "n", F.explode(taken).alias("s")).select("doc_id", "n", "s.h"), "prefix")
    forget(sets)
    forget(shared)
    lists = stored(prefix.groupBy("h").agg(F.min("doc_id").alias("least"), F.count("*").alias("df")).where("df > 1"), "lists")
    stars = join_counted(prefix, lists, "h", "df").where("doc_id <> least").select(F.col("doc_id").alias("u"), F.col("least").alias("v"))
    cluster = stored(components(stars).select(F.col("id").alias("doc_id"), F.col("component").alias("cluster")), "clusters")
    wanted = stored(blocks_of(cluster, prefix, percent, block), "wanted")

    def compare(keys: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
        return forest(rows["doc_id"].to_numpy(), sets, (rows["block"].to_numpy() == keys[0]).astype(np.int64), percent)

    def with_text(some: DataFrame) -> DataFrame:
        return with_sets(join_small(keyed, some.select("doc_id", "block"), "doc_id", "inner", some.count(), 24))

    packed = with_text(wanted).select(F.col("block").alias("low"), F.col("block").alias("high"), "block", "doc_id", "shingles")
    large = wanted.where("large")
    if not large.isEmpty():
        meet = stored(blocks_that_meet(prefix, large), "meet")
        sides = meet.select(F.col("low").alias("block"), "low", "high").union(meet.select(F.col("high").alias("block"), "low", "high"))
        packed = packed.union(with_text(large).join(sides, "block").select("low", "high", "block", "doc_id", "shingles"))
    found = stored(packed.groupBy("low", "high").applyInPandas(compare, "u long, v long, links long"), "links")
    joined = components(found)
    links = found.groupBy(F.col("u").alias("rep")).agg(F.sum("links").alias("n_links"))
    told = joined.withColumnRenamed("id", "rep").join(links, "rep", "left").join(reps.select("rep", "copies"), "rep", "left")
    told = stored(told.withColumn("copies", F.coalesce("copies", F.lit(1).cast("long"))), "told")
    for table in (prefix, lists, cluster, wanted, found):
        forget(table)
    out = join_counted(member, told, "rep", "copies", "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    unnamed = docs.where(F.col(id_col).isNull()).select(F.lit(None).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return out.union(set_rows(unnamed, cut, percent).select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"), F.lit(0).cast("long").alias("n_links")))


def blocks_of(cluster: DataFrame, prefix: DataFrame, percent: int, block: int) -> DataFrame:
    """(doc_id, block, band, large) for rows (doc_id, cluster): a cluster of up to `block` sets is one block.

    A larger one is cut into bands of set sizes, and a band into blocks by the rarest list that a set is in, so sets
    that share lists are together; what is still too many is dealt by hash."""
    size = stored(cluster.groupBy("cluster").agg(F.count("*").alias("n")).withColumn("docs", F.col("n")), "sizes")
    sized = join_counted(cluster, size, "cluster", "n")
    small = sized.where(F.col("docs") <= block).select("doc_id", F.xxhash64("cluster").alias("block"), F.lit(0).cast("long").alias("band"), F.lit(False).alias("large"))
    if size.where(F.col("docs") > block).isEmpty():
        return small
    lists = prefix.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").withColumn("df", F.col("n"))
    met = join_counted(prefix, stored(lists, "lists"), "h", "n")
    band = F.floor(F.log(F.greatest("n", F.lit(1))) / F.log(F.lit(100 / percent)) + F.lit(1e-9)).alias("band")
    first = met.groupBy("doc_id").agg(F.min(F.struct("df", "h"))["h"].alias("first"), F.first("n").alias("n")).select("doc_id", "first", band)
    big = sized.where(F.col("docs") > block).join(first, "doc_id").select("doc_id", "cluster", "band", "first", F.xxhash64("cluster", "band").alias("c"))
    big = stored(big, "large")
    per = stored(big.groupBy("c").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / block)), "bands")
    dealt = stored(join_counted(big, per, "c", "n").withColumn("c", F.xxhash64("c", F.pmod(F.xxhash64("first"), F.col("parts")))).drop("parts"), "dealt")
    over = stored(dealt.groupBy("c").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / block)), "parts")
    dealt = join_counted(dealt, over, "c", "n").select("doc_id", F.xxhash64("c", F.pmod(F.xxhash64("doc_id"), F.col("parts"))).alias("block"), "band", F.lit(True).alias("large"))
    return small.union(dealt)


def blocks_that_meet(prefix: DataFrame, large: DataFrame) -> DataFrame:
    """(low, high): different blocks that an index list has sets of both of and whose sizes can link.

    A list is gathered as the set of its blocks, each of which holds about BLOCK sets; equal lists of blocks count once."""
    at = F.struct("band", "block")
    lists = prefix.select("doc_id", "h").join(large, "doc_id").select("h", at.alias("b")).distinct().groupBy("h").agg(F.array_sort(F.collect_list("b")).alias("b"))
    lists = lists.where(F.size("b") > 1).select("b").distinct()
    pair = lists.select(F.explode("b").alias("x"), "b").select("x", F.explode("b").alias("y")).where((F.col("y.band") - F.col("x.band")).isin(0, 1) & (F.col("x.block") != F.col("y.block")))
    return pair.select(F.least("x.block", "y.block").alias("low"), F.greatest("x.block", "y.block").alias("high")).distinct()


def with_sets(rows: DataFrame) -> DataFrame:
    """(doc_id, block, shingles) from rows with a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                b = whole.slice(k, 1000)
                made = [s.tobytes() for s in shingle_sets([t or b"" for t in b.column(1).to_pylist()])]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(made, pa.binary())], ["doc_id", "block", "shingles"])

    return rows.select("doc_id", F.col("text").cast("binary").alias("text"), "block").mapInArrow(run, "doc_id long, block long, shingles binary")
