"""Near-duplicate vectors: iterative quantisation, multi-index Hamming tables, reranking with the vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forget, join_counted, stored

#: Vectors that the rotations are learned from at most; rows of one block of a bucket.
FIT_ROWS, BLOCK = 20_000, 512
#: Vectors of a label that a bucket is meant to hold; share of pairs at the threshold that may be missed.
BUCKET, MISSED = 32, 0.002


def fit_itq(x: np.ndarray, bits: int, rounds: int = 40, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (dims x bits) whose signs are balanced codes: principal axes, then the rotation that
    brings the projected vectors closest to corners of the cube, by alternating signs and an orthogonal fit."""
    mean = x.mean(0)
    centred = x - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :bits]
    v = centred @ axes
    turn = np.linalg.qr(np.random.default_rng(seed).standard_normal((v.shape[1], v.shape[1])))[0]
    for _ in range(rounds):
        u, _, w = np.linalg.svd(v.T @ np.where(v @ turn >= 0, 1.0, -1.0))
        turn = u @ w
    return mean, axes @ turn


def unit_rows(vectors: list, dims: int) -> np.ndarray:
    """Vectors as unit rows of `dims` numbers, cut or filled with zeros (used for codes only)."""
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        v = np.asarray(v, np.float64)[:dims]
        out[i, : len(v)] = v
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-300)


def merged(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index of each index's component, for edges left[i] - right[i]."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        nxt = root.copy()
        np.minimum.at(nxt, root[left], low)
        np.minimum.at(nxt, root[right], low)
        nxt = nxt[nxt]
        if (nxt == root).all():
            return root
        root = nxt


def table_plan(rows: int, threshold: float) -> tuple[int, int]:
    """(bits of a substring, tables): a substring has about log2(rows / BUCKET) bits, so buckets don't grow with the
    table; there are as many tables as pairs at the threshold would need if a bit of two vectors at an angle differed
    with probability angle / pi, each by itself. measured_tables() goes on from there."""
    bits = min(48, max(1, round(math.log2(max(2, rows / BUCKET)))))
    same = (1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi) ** bits
    return bits, 1 if same >= 1 else max(1, math.ceil(math.log(MISSED) / math.log(1 - same)))


def hamming_radius(bits: int, threshold: float) -> int:
    """The distance of codes beyond which hardly any pair reaches the threshold: four deviations over the mean."""
    p = math.acos(min(1.0, max(-1.0, threshold))) / math.pi
    return math.ceil(bits * p + 4 * math.sqrt(bits * p * (1 - p)))


def measured_tables(fitted: np.ndarray, bits: int, width: int, tables: int, threshold: float, probes: int = 4000, seed: int = 5) -> tuple[np.ndarray, np.ndarray, int, int]:
    """(mean, projection, tables, radius) so that of pairs just at the threshold no more than MISSED is missed, measured.

    Bits of one rotation depend on each other and those near an axis differ more often than the angle tells. So each of
    up to `probes` fitted vectors gets a partner at the threshold in a random direction; the radius holds all but a
    quarter of MISSED of these pairs, and tables with rotations of their own are added until enough pairs meet in one."""
    rng = np.random.default_rng(seed)
    x = fitted[:probes]
    off = rng.standard_normal(x.shape)
    off -= (off * x).sum(1, keepdims=True) * x
    off /= np.maximum(np.linalg.norm(off, axis=1, keepdims=True), 1e-300)
    y = threshold * x + math.sqrt(max(0.0, 1 - threshold**2)) * off
    turns: list[tuple[np.ndarray, np.ndarray]] = []
    most = 8 * tables
    while True:
        while sum(t.shape[1] for _, t in turns) < width * tables:
            turns.append(fit_itq(fitted, bits, seed=3 + len(turns)))
        mean, projection = turns[0][0], np.concatenate([t for _, t in turns], axis=1)
        differs = ((x - mean) @ projection >= 0) != ((y - mean) @ projection >= 0)
        first = turns[0][1].shape[1]
        apart = differs[:, :first].sum(1)
        radius = max(hamming_radius(first, threshold), int(np.quantile(apart, 1 - MISSED / 4, method="higher")))
        meets = (~differs[:, : width * tables].reshape(len(x), tables, width).any(2)).any(1) & (apart <= radius)
        if meets.mean() >= 1 - MISSED or tables >= most:
            return mean, projection, tables, radius
        tables = min(most, tables + max(1, tables // 4))


def same_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[list, pa.Table]]:
    """(first row's keys, rows) of each run of rows that agree in the first `keys` columns, from sorted batches."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        new = np.zeros(b.num_rows, bool)
        for c in b.columns[:keys]:
            v = c.to_numpy(zero_copy_only=False)
            new[1:] |= v[1:] != v[:-1]
        new[0] = not held or any(held[-1].column(k)[held[-1].num_rows - 1] != b.column(k)[0] for k in range(keys))
        cuts = [*np.flatnonzero(new).tolist(), b.num_rows]
        if held and cuts[0] != 0:
            held.append(b.slice(0, cuts[0]))
        elif held:
            yield [c[0].as_py() for c in held[0].columns[:keys]], pa.Table.from_batches(held)
            held = []
        if held and len(cuts) > 1:
            yield [c[0].as_py() for c in held[0].columns[:keys]], pa.Table.from_batches(held)
            held = []
        for a, z in zip(cuts[:-2], cuts[1:-1], strict=True):
            yield [c[a].as_py() for c in b.columns[:keys]], pa.Table.from_batches([b.slice(a, z - a)])
        if len(cuts) > 1:
            held = [b.slice(cuts[-2])]
    if held:
        yield [c[0].as_py() for c in held[0].columns[:keys]], pa.Table.from_batches(held)


def matrix(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
    """A column of lists of one length as rows of numbers."""
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(lists), -1)


def link_vectors(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", fit_rows: int = FIT_ROWS, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors.

    Vectors link if their labels are equal and not null and their cosine in double precision is at least the
    threshold. Null or zero vectors and vectors with null or non-finite parts link with nothing; vectors of different
    lengths don't link. Equal vectors of a label are handled once: their copies count as links of each other. Rows
    that share a vec_id count as copies of one another only if their vectors are equal; a null vec_id returns 0 links
    and itself as component.

    Codes come from rotations learned from fit_rows vectors at most, one rotation for each 64 bits (or for as many as
    the vectors have parts); every vector is indexed. Substrings of them are the keys of the tables, as long and as
    many as table_plan() says for the largest label and
    measured_tables() adds. Vectors that agree in a substring are candidates if their first
    codes are within its radius, and the exact cosine decides. A bucket larger than `block` is dealt as pairs of
    blocks. Within a task pairs are counted, never sent: it returns each vector's links and the edges of a spanning
    forest."""
    v = F.col(vector_col)
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()
    fine = F.coalesce(fine, F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("vector"), F.col(label_col).cast("string").alias("label"), fine.alias("fine"))
    groups = rows.where("fine").groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    groups = stored(groups, "vectors")
    sample = groups.select("vector").orderBy(F.xxhash64("vector")).limit(fit_rows).toPandas()["vector"].tolist()
    if not sample:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    lengths = [len(x) for x in sample]
    dims = max(set(lengths), key=lambda n: (lengths.count(n), n))
    bits = min(64, dims)
    most = groups.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    width, tables = table_plan(most, threshold)
    fitted = unit_rows([x for x in sample if len(x) == dims], dims)
    mean, projection, tables, radius = measured_tables(fitted, bits, width, tables, threshold)
    first = min(bits, projection.shape[1])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            signs = (unit_rows(b.column(0).to_pylist(), dims) - mean) @ projection >= 0
            parts = [signs[:, np.arange(k * width, (k + 1) * width) % signs.shape[1]] @ (1 << np.arange(width)) for k in range(tables)]
            code = (signs[:, :first].astype(np.uint64) << np.arange(first, dtype=np.uint64)).sum(1, dtype=np.uint64).view(np.int64)
            keys = pa.array(np.stack(parts, 1).astype(np.int64).tolist(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*b.columns, keys, pa.array(code)], ["vector", "rep", "copies", "key", "parts", "code"])

    key = F.concat_ws("/", "label", F.size("vector").cast("string")).alias("key")
    coded = groups.select("vector", "rep", "copies", key).mapInArrow(encode, "vector array<double>, rep long, copies long, key string, parts array<long>, code long")
    coded = stored(coded, "codes")
    placed = coded.select("key", "vector", "rep", "copies", "code", "parts", F.posexplode("parts").alias("t", "value"))
    size = coded.select("key", F.posexplode("parts").alias("t", "value")).groupBy("key", "t", "value").agg(F.count("*").alias("n"))
    size = stored(size.where(F.col("n") > block).withColumn("blocks", F.ceil(F.col("n") / block).cast("int")), "buckets")
    if size.isEmpty():
        placed = placed.withColumns({c: F.lit(0) for c in ("low", "high", "mine")})
    else:
        placed = join_counted(placed, size, ["key", "t", "value"], "n", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        placed = placed.withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        placed = placed.withColumns({"low": F.least("mine", "other"), "high": F.greatest("mine", "other")})
    names = ["key", "t", "value", "low", "high"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for keys, found in same_groups(batches, len(names)):
            if found.num_rows > 1:
                got = linked_rows(found, keys[1], keys[3], keys[4], threshold, radius)
                if len(got[0]):
                    out.append(got)
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["rep", "links", "to"])
                out.clear()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["rep", "links", "to"])

    dealt = placed.select(*names, "mine", "vector", "rep", "copies", "code", "parts").repartition(*names).sortWithinPartitions(*names)
    found = stored(dealt.mapInArrow(compare, "rep long, links long, to long"), "links")
    joined = components(found.select(F.col("rep").alias("u"), F.col("to").alias("v")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    per = groups.join(links, "rep", "left").join(joined.withColumnRenamed("id", "rep"), "rep", "left")
    told = per.select("label", "vector", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "rep").alias("c"))
    out = join_counted(rows, stored(told, "told"), ["label", "vector"], "copies", "left")
    for table in (coded, size, found):
        forget(table)
    c = F.when(F.col("fine"), F.col("c")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.when(F.col("fine"), F.col("n")).otherwise(F.lit(0)).cast("long").alias("n_links"), c.alias("component_id"), F.coalesce(c == F.col("vec_id"), F.lit(True)).alias("kept"))


def linked_rows(rows: pa.Table, t: int, low: int, high: int, threshold: float, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rep, links, smallest linked rep) of the rows of a bucket, or of two blocks of one, that link with another.

    Codes within the radius are reranked by exact cosine; a pair counts only in the first table where it meets."""
    x, parts = matrix(rows.column("vector"), np.float64), matrix(rows.column("parts"), np.int64)
    code, rep, copies, mine = (rows.column(c).to_numpy() for c in ("code", "rep", "copies", "mine"))
    code = code.view(np.uint64)  # of a signed number bitwise_count takes the absolute value
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    a = np.flatnonzero(mine == low)
    z = a if low == high else np.flatnonzero(mine == high)
    links, lefts, rights = np.zeros(len(x), np.int64), [], []
    for at in range(0, len(a), 256):
        part = a[at : at + 256]
        i, j = np.nonzero(np.bitwise_count(code[part][:, None] ^ code[z][None, :]) <= radius)
        i, j = part[i], z[j]
        keep = i < j if low == high else np.ones(len(i), bool)
        for before in range(t):
            keep &= parts[i, before] != parts[j, before]
        i, j = i[keep], j[keep]
        near = np.concatenate([np.einsum("ij,ij->i", x[i[k : k + 65536]], x[j[k : k + 65536]]) for k in range(0, len(i), 65536)] or [np.zeros(0)]) / (norm[i] * norm[j]) >= threshold
        i, j = i[near], j[near]
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        if len(i):
            root = merged(len(x), np.concatenate([*lefts, i]), np.concatenate([*rights, j]))
            tied = np.flatnonzero(root != np.arange(len(x)))
            lefts, rights = [tied], [root[tied]]
    to = np.arange(len(x))
    if lefts:
        to[lefts[0]] = rights[0]
    some = (links > 0) | (rep[to] != rep)
    return rep[some], links[some], rep[to][some]
