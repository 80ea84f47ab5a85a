"""What several operators share: stored tables, checked broadcasts, documents keyed by id, word shingles, components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import shared_folder

#: Bytes that a broadcast side may take, by its counted rows and their width; beyond it the join shuffles.
BROADCAST_BYTES = 8 << 20
#: A key is hot with more than HOT_ROWS rows and more than 1 / HOT_KEYS of all: there are never more than HOT_KEYS of
#: them. Where keys aren't counted before, one of HOT_SHARE documents is looked at for those that come HOT_SEEN times.
HOT_ROWS, HOT_KEYS, HOT_SHARE, HOT_SEEN = 1000, 10_000, 16, 32


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def forget(df: DataFrame) -> None:
    """Delete a table of stored() that nothing reads any more."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def join_small(left: DataFrame, right: DataFrame, on: str | list[str], how: str, rows: int, width: int = 16) -> DataFrame:
    """Join with a side whose number of rows has been counted: broadcast up to BROADCAST_BYTES, shuffled beyond it."""
    return left.join(F.broadcast(right) if rows * width <= BROADCAST_BYTES else right, on, how)


def join_counted(left: DataFrame, right: DataFrame, on: str | list[str], n: str, how: str = "inner") -> DataFrame:
    """Join (inner or left) with a stored side of one row per key that says in `n` how many rows of left have the key.

    Hot keys, of which there are HOT_KEYS at most, are looked up by broadcast and their rows spread over the tasks of
    the shuffled join, in which they meet nothing. `n` isn't in the result."""
    total = right.agg(F.sum(n)).first()[0] or 0
    hot = F.col(n) > max(HOT_ROWS, total // HOT_KEYS)
    if right.where(hot).isEmpty():
        return left.join(right.drop(n), on, how)
    keys = [on] if isinstance(on, str) else on
    more = [c for c in right.columns if c not in keys and c != n]
    named = lambda mark: [*keys, *[F.col(c).alias(f"{c}_{mark}") for c in more], F.lit(True).alias(f"_{mark}")]
    marked = left.join(F.broadcast(right.where(hot).select(*named("hot"))), keys, "left")
    marked = marked.withColumn("_spread", F.when(F.col("_hot"), F.xxhash64(*left.columns)).otherwise(F.lit(0).cast("long")))
    out = marked.join(right.where(~hot).select(*named("rest"), F.lit(0).cast("long").alias("_spread")), [*keys, "_spread"], "left")
    out = out if how == "left" else out.where(F.coalesce("_hot", "_rest"))
    return out.select(*left.columns, *[F.coalesce(f"{c}_hot", f"{c}_rest").alias(c) for c in more])


def common_keys(rows: DataFrame, key: str) -> DataFrame:
    """The keys that come HOT_SEEN times or more in rows, which are a share of all; HOT_KEYS at most, the commonest.

    Only tells which keys to spread over tasks; results don't depend on it."""
    often = rows.groupBy(key).agg(F.count("*").alias("seen")).where(F.col("seen") >= HOT_SEEN)
    return stored(often.orderBy(F.desc("seen"), key).limit(HOT_KEYS).select(key), "common")


def in_share(by: str) -> Column:
    """One of HOT_SHARE documents, by hash."""
    return F.pmod(F.xxhash64(by, F.lit(11)), F.lit(HOT_SHARE)) == 0


def keys_met_again(rows: DataFrame, key: str, by: str, often: DataFrame, df: str = "df") -> DataFrame:
    """rows whose key occurs more than once, with the number of its rows in `df`.

    Rows of the common keys in `often` get the number from a partial count and are spread by `by`; the window over the
    others sees few rows of a key."""
    mark = rows.join(F.broadcast(often.withColumn("_often", F.lit(True))), key, "left")
    counts = mark.groupBy(F.when(F.col("_often"), F.col(key)).alias(key)).agg(F.count("*").alias("_all"))  # the rest is one null
    marked = rows.join(F.broadcast(counts), key, "left")
    spread = F.when(F.col("_all").isNotNull(), F.pmod(F.xxhash64(by), F.lit(1 << 20)))
    n = F.coalesce("_all", F.count("*").over(Window.partitionBy(key, spread)))
    return marked.withColumn(df, n).where(F.col(df) > 1).drop("_all")


LIBC = ctypes.CDLL(None)
#: What a worker process keeps between tasks, by name, as functions that drop it.
KEPT: dict[str, Callable[[], None]] = {}


def keeps(name: str, drop: Callable[[], None]) -> None:
    """Tell that this process keeps something under a name, and how to drop it."""
    KEPT[name] = drop


def drop_kept(but: str = "") -> None:
    """A worker serves tasks of several operators: a task starts by dropping what other operators' tasks have kept."""
    for name in [n for n in KEPT if n != but]:
        KEPT.pop(name)()
    pa.default_memory_pool().release_unused()
    gc.collect()
    if hasattr(LIBC, "malloc_trim"):  # glibc keeps what was freed unless it's asked to give it back
        LIBC.malloc_trim(0)


def small_batches(df: DataFrame) -> DataFrame:
    """df, with Arrow batches of 2,000 rows instead of Spark's default of 10,000, as its texts can be long.

    A number that the session names itself stays."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(name) == "10000":
        conf.set(name, "2000")
    return df


def unique_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with one row per id that is not null. Of rows that share an id the smallest text counts.

    Only ids are shuffled to see whether any is repeated; texts move only if one is."""
    keyed = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(F.col("doc_id").isNotNull())
    repeated = keyed.groupBy("doc_id").count().where("count > 1").limit(1).count()
    return keyed.groupBy("doc_id").agg(F.min("text").alias("text")) if repeated else keyed


# --- word shingles -----------------------------------------------------------------------------------------------

WIDTH = 5
_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_SLOT = [_U(int(x) | 1) for x in _rng.integers(1, 2**63, 8, dtype=np.uint64)]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    key = f"{base}"
    if key not in _powers or _powers[key].shape[1] < n:
        size = 1 << max(16, (n - 1).bit_length())
        out = np.ones((2, size), np.uint64)
        for row, b in enumerate((base, pow(base, -1, 2**64))):
            done, step = 1, b
            while done < size:
                out[row, done : 2 * done] = out[row, :done] * _U(step)
                done, step = 2 * done, step * step % 2**64
        _powers[key] = out
    return _powers[key][0, :n], _powers[key][1, :n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that equal inputs stay equal and the order of the outputs looks random."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def prefix_sums(data: np.ndarray, table: np.ndarray = _BYTE) -> tuple[np.ndarray, np.ndarray]:
    """Sums S with which (S[b] - S[a]) * inverse[a] is a polynomial hash of data[a:b]."""
    power, inverse = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * power[:-1], out=sums[1:])
    return sums, inverse


def text_blocks(texts: list[bytes], most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` bytes together; a longer text stands alone."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if texts:
        yield start, len(texts)


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """For each text its sorted distinct 64-bit hashes of five-word shingles.

    A-Z count as a-z; words are cut at bytes 9-13 and 32. A text of one to four words has one element, for the
    whole sequence; one without words has none. Equal hashes stand for equal shingles (64 bits)."""
    for a, b in text_blocks(texts):
        data = np.frombuffer(b"\n".join(texts[a:b]).lower() + b"\n", np.uint8)
        lengths = np.fromiter((len(t) + 1 for t in texts[a:b]), np.int64, b - a)
        ends = np.cumsum(lengths)
        gap = _SPACE[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], gap)).view(np.int8)))
        first, last = edge[0::2], edge[1::2]
        sums, inverse = prefix_sums(data)
        word = mixed((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64))
        bounds = np.searchsorted(first, np.concatenate(([0], ends)))
        n = max(0, len(word) - WIDTH + 1)
        rolled = np.zeros(n, np.uint64)
        for i in range(WIDTH):
            rolled = rolled + word[i : i + n] * _SLOT[i]
        rolled = mixed(rolled)
        for i in range(b - a):
            x, y = int(bounds[i]), int(bounds[i + 1])
            if y - x >= WIDTH:
                yield np.unique(rolled[x : y - WIDTH + 1])
            elif y > x:
                whole = sum(int(w) * int(s) for w, s in zip(word[x:y], _SLOT, strict=False)) + (y - x) * int(_SLOT[7])
                yield mixed(np.array([whole % 2**64], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


# --- connected components ----------------------------------------------------------------------------------------


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(id, component): the smallest id reachable over the edges, for every id that has an edge.

    Large-star and small-star steps with minima and joins only: no neighbour list is gathered anywhere, the edges of a
    node with very many are joined by broadcast, and each round is stored in the shared folder. Ends when a round
    changes nothing, however many it takes."""
    edges = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u <> v").distinct()
    now, mark = stored(edges, "edges"), None
    while True:
        # large star: every larger neighbour of a node goes to the smallest node of its neighbourhood
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n")), "least")
        large = join_counted(both, least, "u", "n").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: a node and its smaller neighbours go to the smallest of them
        large = stored(large.where("u <> v").distinct(), "edges")
        low = stored(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "least")
        small = join_counted(large, low, "u", "n").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        nxt = stored(small.where("u <> v").distinct(), "edges")
        new = nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        for table in (now, least, large, low):
            forget(table)
        now = nxt
        if new == mark:
            break
        mark = new
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
