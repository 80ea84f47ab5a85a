"""Repeated byte strings across documents, from enhanced suffix arrays over anchored suffixes.

A string of at least 100 bytes contains, wherever it stands, the same anchor: the 32-byte gram with the smallest hash
in a window. So suffixes are compared only where anchors are equal. Each anchor's suffixes are sorted, their common
prefixes scanned with a stack (the interval tree), and each interval's occurrences are told apart by what stands
before the anchor: a split there ends a repeat on the left, the interval's end ends it on the right. What remains are
the maximal repeats with all their occurrences."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import common_keys, drop_kept, in_share, join_counted, join_small, mixed, prefix_sums, stored, unique_documents

#: Bytes of a repeat at least; of an anchor; of a text that a task takes at once; occurrences that one task compares.
LEAST, GRAM, PIECE, GROUP = 100, 32, 1 << 18, 50_000
_MASK = np.uint64((1 << 26) - 1)


def anchors(texts: list[bytes], least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, position, first, last) of each anchor: it stands for the windows that start at first..last.

    Texts longer than PIECE are taken in pieces that overlap by least - 1 bytes."""
    w = least - gram + 1
    pieces = [(i, at, t[at : at + PIECE + least - 1]) for i, t in enumerate(texts) for at in range(0, max(1, len(t) - least + 1), PIECE) if len(t) >= least]
    out: list[tuple[np.ndarray, ...]] = []
    k = 0
    while k < len(pieces):
        end, size = k, 0
        while end < len(pieces) and (end == k or size + len(pieces[end][2]) <= PIECE):
            size += len(pieces[end][2])
            end += 1
        part = pieces[k:end]
        k = end
        data = np.frombuffer(b"".join(p[2] for p in part), np.uint8)
        sums, inverse = prefix_sums(data)
        n = len(data) - gram + 1
        hashes = mixed((sums[gram:] - sums[:n]) * inverse[:n])
        keyed = (hashes & ~_MASK) | np.arange(n, dtype=np.uint64)
        pad = -n % w + w
        grid = np.concatenate([keyed, np.full(pad, 2**64 - 1, np.uint64)]).reshape(-1, w)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        lengths = np.array([len(p[2]) for p in part])
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        count = lengths - least + 1
        which = np.repeat(np.arange(len(part)), count)
        window = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + starts[which]
        chosen = (np.minimum(behind[window], ahead[window + w - 1]) & _MASK).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (which[1:] != which[:-1]))))
        last = np.concatenate((new[1:], [len(chosen)])) - 1
        base = np.array([p[1] for p in part]) - starts
        shift = base[which[new]]
        out.append((np.array([p[0] for p in part])[which[new]], hashes[chosen[new]], chosen[new] + shift, window[new] + shift, window[last] + shift))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 5


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of the intervals of a sorted list in which all share `length` >= least, by a stack scan.

    lcp[i] is what entries i - 1 and i share; lcp[0] is not used."""
    stack: list[tuple[int, int]] = []
    for i in range(1, len(lcp) + 1):
        here, left = (lcp[i] if i < len(lcp) else -1), i - 1
        while stack and stack[-1][0] > here:
            length, left = stack.pop()
            yield length, left, i - 1
        if here >= least and (not stack or stack[-1][0] < here):
            stack.append((here, left))


def maximal_repeats(before: list[bytes], after: list[bytes], least: int = LEAST) -> Iterator[tuple[int, int, list[int]]]:
    """(bytes before the anchor, bytes from it on, occurrences) of each maximal repeat of at least `least` bytes.

    before: what stands before each occurrence, reversed; after: the anchor and what follows. A set of occurrences is
    reported once, with all that they share on both sides."""
    order = sorted(range(len(after)), key=after.__getitem__)
    lcp = [0] + [common(after[a], after[b]) for a, b in zip(order, order[1:], strict=False)]
    place = {x: i for i, x in enumerate(order)}
    longest = max(map(len, before))
    for right, first, last in intervals(lcp, max(1, least - longest)):
        members = sorted(order[first : last + 1], key=before.__getitem__)
        shared = [0] + [common(before[a], before[b]) for a, b in zip(members, members[1:], strict=False)]
        for left, x, y in intervals(shared, max(0, least - right)):
            found = members[x : y + 1]
            at = sorted(place[m] for m in found)
            if min(lcp[at[0] + 1 : at[-1] + 1]) > right:
                continue  # they share more on the right: a narrower interval reports them
            yield left, right, found


def contexts(docs: DataFrame, candidates: DataFrame, least: int) -> DataFrame:
    """(h, doc_id, at, context) of candidate anchors; within a batch, equal contexts of one anchor are sent once: the
    others stand later, so all their windows are repeats, and their context is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                b = whole.slice(k, 500)
                rows = []
                for doc, text, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                    for f in found:
                        pos, left, span = f["at"] >> 14, f["at"] >> 7 & 127, f["at"] & 127
                        rows.append((doc, f["at"], f["h"], left, text[pos - left : pos - left + span + least]))
                rows.sort(key=lambda r: r[:2])
                seen: set[tuple] = set()
                out = []
                for doc, at, h, left, context in rows:
                    mark = (h, left, context)
                    out.append((h, doc, at, None if mark in seen else context))
                    seen.add(mark)
                cols = list(zip(*out, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["h", "doc_id", "at", "context"])

    joined = docs.join(candidates, "doc_id").select("doc_id", F.col("text").cast("binary").alias("text"), "found")
    return joined.mapInArrow(run, "h long, doc_id long, at long, context binary")


def by_anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Whole groups of rows (h, doc, at, context) with one h, from sorted batches; a group may span batches."""
    group: list[tuple] = []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if group and group[-1][0] != row[0]:
                yield group
                group = []
            group.append(row)
    if group:
        yield group


def compared(rows: DataFrame, least: int, every: bool) -> DataFrame:
    """Compare the suffixes of each anchor. every: (h, repeat, doc_id, start, length, first) of all maximal repeats;
    else the bytes (doc_id, start, stop) around an anchor that also stand earlier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        kinds = [pa.int64()] * 5 + [pa.bool_()] if every else [pa.int64()] * 3

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [()] * len(kinds)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds, strict=True)], names)

        for group in by_anchor(batches):
            if len(group) == 1:
                continue
            group.sort(key=lambda r: (r[1], r[2]))
            lefts = [r[2] >> 7 & 127 for r in group]
            before = [r[3][:n][::-1] for r, n in zip(group, lefts, strict=True)]
            after = [r[3][n:] for r, n in zip(group, lefts, strict=True)]
            reach: dict[int, list[int]] = {}
            for number, (left, right, found) in enumerate(maximal_repeats(before, after, least)):
                first = min(found)
                for i in found:
                    pos = group[i][2] >> 14
                    if every:
                        out.append((group[i][0], number, group[i][1], pos - left, left + right, i == first))
                    elif i != first:
                        r = reach.setdefault(i, [0, 0])
                        r[0], r[1] = max(r[0], left), max(r[1], right)
            for i, (left, right) in reach.items():
                pos = group[i][2] >> 14
                out.append((group[i][1], pos - left, pos + right))
            if len(out) > 20_000:
                yield batch()
        yield batch()

    names = ["h", "repeat", "doc_id", "start", "length", "first"] if every else ["doc_id", "start", "stop"]
    schema = "h long, repeat long, doc_id long, start long, length long, first boolean" if every else "doc_id long, start long, stop long"
    return rows.select("h", "doc_id", "at", "context").repartition("h").sortWithinPartitions("h").mapInArrow(run, schema)


def by_window(rows: DataFrame, least: int) -> DataFrame:
    """(doc_id, start, stop) for anchors with too many occurrences for one task: each window by itself, grouped by its
    bytes with partial minima, so nothing but the earliest place of a window is gathered."""
    left = F.expr("shiftright(at, 7) & 127")
    each = rows.select("doc_id", "context", (F.expr("shiftright(at, 14)") - left).alias("base"), F.explode(F.sequence(F.lit(0), F.octet_length("context") - least)).alias("k"))
    each = each.select("doc_id", (F.col("base") + F.col("k")).alias("start"), F.substring("context", F.col("k") + 1, F.lit(least)).alias("window"))
    each = each.withColumn("window", F.unhex(F.sha2("window", 256))).distinct()
    first = each.groupBy("window").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    later = each.join(first, "window").where(F.struct("doc_id", "start") != F.col("first"))
    return later.select("doc_id", "start", (F.col("start") + least).alias("stop"))


def candidates_of(keyed: DataFrame, least: int, gram: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with their copies, rows to compare, copies): the steps before any comparison."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                b = whole.slice(k, 1000)
                doc = b.column(0).to_numpy(zero_copy_only=False)
                text, h, pos, first, last = anchors([t or b"" for t in b.column(1).to_pylist()], least, gram)
                at = pos << 14 | pos - first << 7 | last - first
                yield pa.RecordBatch.from_arrays([pa.array(h.astype(np.uint64).view(np.int64)), pa.array(doc[text].astype(np.int64)), pa.array(at.astype(np.int64))], ["h", "doc_id", "at"])

    if least - gram > 127 or gram > least:
        raise ValueError("an anchor is as long as a repeat at most, and shorter by 127 bytes at most")
    digest = F.unhex(F.md5("text"))
    mark = keyed.where(F.octet_length("text") >= least).select("doc_id", digest.alias("digest"))
    earliest = stored(mark.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1"), "earliest")
    copies = stored(join_counted(mark, earliest, "digest", "n").where("doc_id <> first").select("doc_id"), "copies")
    own = join_small(keyed.where(F.octet_length("text") >= least), copies, "doc_id", "left_anti", copies.count())

    def found_in(docs: DataFrame) -> DataFrame:
        return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, "h long, doc_id long, at long")

    # common anchors surely occur again: they needn't be counted, and are spread over the tasks that count the others
    often = common_keys(found_in(own.where(in_share("doc_id"))), "h").withColumn("often", F.lit(True))
    found = found_in(own).join(F.broadcast(often), "h", "left")
    spread = F.when(F.col("often"), F.xxhash64("doc_id", "at"))
    twice = found.withColumn("df", F.count("*").over(Window.partitionBy("h", spread))).where("df > 1 or often")
    per = twice.groupBy("doc_id").agg(F.collect_list(F.struct("h", "at")).alias("found"))
    rows = stored(contexts(keyed, stored(per, "anchors"), least), "contexts")
    return own, rows, copies


def repeat_groups(docs: DataFrame, least: int = LEAST, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Maximal repeats around each anchor: h, repeat (their number within h), doc_id, start, length, first.

    Whole copies of an earlier text are left out, as are later occurrences that equal an earlier one within a batch
    over the whole stretch around the anchor. Longer repeats show as overlapping stretches, one for each anchor."""
    _, rows, _ = candidates_of(unique_documents(docs, id_col, text_col), least, gram)
    return compared(rows.where("context is not null"), least, True)


def repeated_spans(docs: DataFrame, least: int = LEAST, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """(doc_id, spans): the maximal runs [start, stop) of bytes covered by a string of `least` bytes that also starts
    earlier (in a smaller doc_id, or before in the same document); documents without any have no row.

    Strings are judged on the input texts as UTF-8 and never cross documents; null texts are empty. Rows that share a
    doc_id count as one document (its smallest text); rows without doc_id are left out. Anchors are shuffled first
    (one for about 35 bytes of text), texts only of documents that share an anchor; an anchor with more than `group`
    different contexts is settled window by window with partial minima instead of in one task."""
    keyed = unique_documents(docs, id_col, text_col)
    _, rows, copies = candidates_of(keyed, least, gram)
    left = F.expr("shiftright(at, 7) & 127")
    start = F.expr("shiftright(at, 14)") - left
    later = rows.where("context is null").select("doc_id", start.alias("start"), (start + F.expr("at & 127") + least).alias("stop"))
    open_ = rows.where("context is not null")
    hot = stored(open_.groupBy("h").count().where(F.col("count") > group).select("h"), "hot")
    n = hot.count()
    found = compared(open_, least, False) if not n else compared(join_small(open_, hot, "h", "left_anti", n), least, False).union(by_window(join_small(open_, hot, "h", "left_semi", n), least))
    whole = join_small(keyed.select("doc_id", F.octet_length("text").alias("size")), copies, "doc_id", "left_semi", copies.count()).select("doc_id", F.lit(0).cast("long").alias("start"), F.col("size").cast("long").alias("stop"))
    spans = found.union(later).union(whole)
    run = Window.partitionBy("doc_id").orderBy("start", "stop")
    reach = F.max("stop").over(run.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.when(F.col("start") <= reach, 0).otherwise(1)).withColumn("island", F.sum("new").over(run))
    spans = spans.groupBy("doc_id", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return spans.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def kept_bytes(text: bytes, spans: list[dict]) -> bytes:
    """What is left of a text without the spans."""
    parts, at = [], 0
    for s in spans:
        parts.append(text[at : s["start"]])
        at = s["stop"]
    return b"".join([*parts, text[at:]])


def removal_digests(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every document; see repeated_spans().

    Rows without doc_id are returned too, with nothing removed."""
    spans = stored(repeated_spans(docs, least, id_col=id_col, text_col=text_col, **more), "spans")
    keyed = unique_documents(docs, id_col, text_col)
    n, size = spans.agg(F.count("*"), F.sum(F.size("spans") * 16 + 48)).first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [hashlib.sha256(kept_bytes(t, s)).hexdigest() for t, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            size = [len(t) for t in b.column(1).to_pylist()]
            gone = [sum(x["stop"] - x["start"] for x in s) for s in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array([len(s) for s in b.column(2).to_pylist()], pa.int64()), pa.array(made, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    cut = join_small(keyed, spans, "doc_id", "inner", size or 0, 1).select("doc_id", raw, "spans").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    none = docs.where(F.col(id_col).isNull()).select(F.lit(None).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    clean = join_small(keyed, spans.select("doc_id"), "doc_id", "left_anti", n).union(none).select("doc_id", raw)
    return cut.union(clean.select("doc_id", F.octet_length("text").cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long"), F.sha2("text", 256)))
