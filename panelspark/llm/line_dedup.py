"""Line deduplication: hashes of lines in ranges, streamed in order, to a compressed bitmap of kept lines per document."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from .common import drop_kept, small_batches, stored

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A document is its id and a hash of id and text; `at` numbers its lines from 0.
VERDICT = {"doc_id": pa.int64(), "row": pa.int64(), "at": pa.int32(), "h1": pa.int64(), "h2": pa.int64(), "part": pa.int32(), "first": pa.bool_(), "docs": pa.int64(), "dropped": pa.bool_()}
VERDICT_DDL = "doc_id long, row long, at int, h1 long, h2 long, part int, first boolean, docs long, dropped boolean"


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, text): null texts are empty. Rows that agree in id and text have the same `row`."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")


def line_keys(rows: DataFrame, least_points: int = 1) -> DataFrame:
    """(doc_id, row, at, h1, h2): 128 bits of each line's key, which is the line stripped of blanks, A-Z as a-z.

    Keys of fewer than least_points code points are left out: their lines always stay."""
    lines = rows.select("doc_id", "row", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    key = F.translate(F.btrim("line", F.lit(BLANKS)), UPPER, LOWER)
    lines = lines.select("doc_id", "row", "at", key.alias("key")).where(F.char_length("key") >= least_points)
    return lines.select("doc_id", "row", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))


class Runs:
    """Streams the rows of one range in the order (hash, document, place) and tells which lines go.

    Of the run of a hash only what lies before its least_docs-th document waits. A run at an edge of the range may go on
    in the next one: what waits of it is given out undecided, with the number of its documents here."""

    def __init__(self, least_docs: int, keep_first: bool, part: int):
        self.least, self.keep_first, self.part = least_docs, keep_first, part
        self.key: tuple | None = None
        self.doc: tuple | None = None
        self.docs, self.head, self.waiting, self.edge = 0, True, [], True
        self.out: list[dict[str, np.ndarray]] = []

    def emit(self, rows: dict[str, np.ndarray], take: np.ndarray, first: np.ndarray, dropped: bool | None) -> None:
        if len(take):
            self.out.append({k: v[take] for k, v in rows.items()} | {"first": first, "dropped": np.full(len(take), dropped, object), "docs": np.full(len(take), None, object)})

    def extend(self, rows: dict[str, np.ndarray], a: int, b: int, docs: int) -> None:
        """The run goes on with rows a to b, in which `docs` documents begin."""
        self.docs += docs
        take = np.arange(a, b)
        first = np.zeros(b - a, bool)
        if self.head:
            first[0], self.head = True, False
        self.waiting.append(({k: v[a:b] for k, v in rows.items()}, first))
        if self.docs >= self.least:
            for held, starts in self.waiting:
                undecided = starts if self.keep_first else np.zeros(len(starts), bool)
                self.emit(held, np.flatnonzero(~undecided), starts[~undecided], True)
                if self.edge:  # the first of this range may not be the first of all
                    self.emit(held, np.flatnonzero(undecided), starts[undecided], None)
            self.waiting = []

    def close(self, edge: bool) -> None:
        if edge and self.key is not None:
            for held, starts in self.waiting:
                self.emit(held, np.arange(len(starts)), starts, None)
            one = {"doc_id": None, "row": 0, "at": -1, "h1": self.key[0], "h2": self.key[1], "first": False, "dropped": None, "docs": self.docs}
            self.out.append({k: np.array([v], object) for k, v in one.items()})
        self.waiting, self.docs, self.head, self.edge = [], 0, True, False

    def feed(self, rows: dict[str, np.ndarray]) -> None:
        h1, h2, known, doc = rows["h1"], rows["h2"], rows["known"], rows["doc"]
        before = lambda x, last: np.concatenate(([last], x[:-1]))
        new = (h1 != before(h1, self.key[0] if self.key else 0)) | (h2 != before(h2, self.key[1] if self.key else 0))
        new[0] |= self.key is None
        other = new | (doc != before(doc, self.doc[0] if self.doc else 0)) | (known != before(known, self.doc[1] if self.doc else False))
        other, starts = other.astype(np.int64), np.flatnonzero(new)
        rows = {k: v for k, v in rows.items() if k not in ("known", "doc")}
        goes_on = int(starts[0]) if len(starts) else len(h1)
        if goes_on:
            self.extend(rows, 0, goes_on, int(other[:goes_on].sum()))
        if len(starts):
            self.close(self.edge)
            docs = np.add.reduceat(other, starts)
            if self.key is None:  # the first run of the range is an edge
                self.key, self.edge = (h1[0], h2[0]), True
                whole = 0
                if len(starts) > 1:
                    self.extend(rows, 0, int(starts[1]), int(docs[0]))
                    self.close(True)
                    whole = 1
            else:
                whole = 0
            gone = np.repeat(docs[whole:-1] >= self.least, np.diff(starts[whole:]))
            take = np.flatnonzero(gone) + starts[whole]
            take = take[~new[take]] if self.keep_first else take
            self.emit(rows, take, new[take], True)
            last = int(starts[-1])
            self.key = (h1[last], h2[last])
            self.extend(rows, last, len(h1), int(docs[-1]))
        self.doc = (doc[-1], known[-1])

    def taken(self) -> Iterator[pa.RecordBatch]:
        for x in self.out:
            x["part"] = np.full(len(x["at"]), self.part)
            yield pa.RecordBatch.from_arrays([pa.array(x[n].tolist(), kind) for n, kind in VERDICT.items()], names=list(VERDICT))
        self.out = []


def dropped_lines(keys: DataFrame, least_docs: int, keep_first: bool) -> DataFrame:
    """(doc_id, row, at) of the lines whose key is in least_docs documents or more, without the first such line if
    keep_first. A document is a doc_id here (null is one); first is by doc_id (null first), row and place.

    Hashes are dealt in ranges of (hash, doc_id), so the rows of a line that all documents hold lie in many ranges,
    those of one document with it in one. Edges of ranges, two rows each, are put together at the end."""
    order = ["h1", "h2", "doc_id"]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        runs = Runs(least_docs, keep_first, TaskContext.get().partitionId())
        for batch in batches:
            if not batch.num_rows:
                continue
            doc = batch["doc_id"]
            cols = {n: batch[n].to_numpy(zero_copy_only=False) for n in ("row", "at", "h1", "h2")}
            cols["doc"], cols["known"] = doc.fill_null(0).to_numpy(zero_copy_only=False), doc.is_valid().to_numpy(zero_copy_only=False)
            cols["doc_id"] = np.where(cols["known"], cols["doc"].astype(object), None)
            runs.feed(cols)
            yield from runs.taken()
        runs.close(True)
        yield from runs.taken()

    told = stored(keys.repartitionByRange(*order).sortWithinPartitions(*order, "row", "at").mapInArrow(stream, VERDICT_DDL), "lines")
    edges = told.where("docs is not null").groupBy("h1", "h2").agg(F.sum("docs").alias("all_docs"), F.min("part").alias("first_part"))
    is_first = F.col("first") & (F.col("part") == F.col("first_part")) if keep_first else F.lit(False)
    open_rows = told.where("docs is null and dropped is null").join(edges, ["h1", "h2"]).where((F.col("all_docs") >= least_docs) & ~is_first)
    return told.where("dropped").select("doc_id", "row", "at").union(open_rows.select("doc_id", "row", "at"))


def packed(dropped: np.ndarray, n_lines: int) -> bytes | None:
    """The bits of kept lines, from the lowest of each byte on, compressed; None if all are kept."""
    if not len(dropped):
        return None
    keep = np.ones(n_lines, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 6)


def unpacked(bitmap: bytes | None, n_lines: int) -> np.ndarray:
    if bitmap is None:
        return np.ones(n_lines, bool)
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines, bitorder="little").astype(bool)


def keep_bitmaps(docs: DataFrame, least_docs: int = 2, least_points: int = 1, keep_first: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, n_lines, n_dropped, keep): a compressed bitmap of kept lines for each document, and no text.

    Lines are cut at line feeds; their keys are stripped of blanks at both ends, with A-Z as a-z, and are compared by
    128-bit hashes. Lines of keys of at least least_points code points that least_docs documents or more hold go: all
    but the first of all, or all. Null or empty text is one empty line. Rows that share an id count as one document but
    each different text has a row of its own; a null id is a document too; equal rows have one row here. An empty table
    gives none. Texts of any length are read whole; only hashes and places are shuffled."""
    rows = keyed(small_batches(docs), id_col, text_col)
    gone = dropped_lines(stored(line_keys(rows, least_points), "line_keys"), least_docs, keep_first)
    n_lines = (F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1).cast("int")
    both = rows.select("doc_id", "row", n_lines.alias("n_lines"), F.lit(None).cast("int").alias("at")).union(gone.select("doc_id", "row", F.lit(None).cast("int"), "at"))
    per = both.groupBy("doc_id", "row").agg(F.max("n_lines").alias("n_lines"), F.array_distinct(F.collect_list("at")).alias("gone"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for b in batches:
            n = b["n_lines"].to_numpy(zero_copy_only=False)
            bits = pa.array([packed(np.asarray(g.values, np.int64), k) for g, k in zip(b["gone"], n, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["row"], b["n_lines"].cast(pa.int64()), b["gone"].value_lengths().cast(pa.int64()), bits], names=["doc_id", "row", "n_lines", "n_dropped", "keep"])

    return per.mapInArrow(pack, "doc_id long, row long, n_lines long, n_dropped long, keep binary")


def kept_texts(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) with the kept lines joined by line feeds, for every row of docs; with
    digest, kept_sha256 in place of the text. Only here do texts move, to their bitmaps."""
    rows = keyed(small_batches(docs), id_col, text_col).alias("d")
    met = rows.join(bitmaps.alias("b"), F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("d.row") == F.col("b.row")))
    name = "kept_sha256" if digest else "text"

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for b in batches:
            out = []
            for text, n, bits in zip(b["text"], b["n_lines"].to_pylist(), b["keep"].to_pylist(), strict=True):
                raw = text.as_buffer().to_pybytes()
                if bits is not None:
                    lines = raw.split(b"\n")
                    raw = b"\n".join([lines[i] for i in np.flatnonzero(unpacked(bits, n))])
                out.append(hashlib.sha256(raw).hexdigest() if digest else raw.decode())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["n_lines"], b["n_dropped"], pa.array(out, pa.string())], names=["doc_id", "n_lines", "n_dropped", name])

    return met.select("d.doc_id", "d.text", "n_lines", "n_dropped", "keep").mapInArrow(keep, f"doc_id long, n_lines long, n_dropped long, {name} string")
