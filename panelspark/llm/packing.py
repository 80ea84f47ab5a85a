"""Sum-of-squares online packing of tokenised documents into fixed windows."""

from __future__ import annotations

import array
import functools
import os
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import drop_kept, keeps, small_batches

WINDOW = 2048
#: Windows that a packer keeps open at most: beyond it they are refilled from each other (16 MB of ids).
MOST_OPEN = 2048
#: Ids that one Arrow batch of results holds, about.
BATCH_IDS = 1 << 20
#: Stretches whose ids a worker remembers, and how many more it makes before it forgets them for newer ones.
REMEMBERED, STALE = 200_000, 5_000_000
LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
LETTERS_FIRST = re.compile(r"([^\W\d_]+)([!-@\[-`{-~].*)", re.S)

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"


class Words(dict):
    """Ids, as little-endian bytes, of stretches between spaces and line feeds, made by the tokenizer when asked first.

    Letters before the first ASCII sign of a stretch are a stretch of their own: the tokenizer's splitter cuts there
    too, so `word,` and `word` share their letters, and ASCII letters are looked up in lower case. It doesn't cut after
    a letter that its normalizer ends with a combining mark; such a stretch stays whole."""

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.tokenizer = Tokenizer.from_file(file)
        self.model = self.tokenizer.model
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.table = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100) if c != 0xF7}
        self.parts: dict[str, bytes] = {}
        self.made = 0

    def part(self, text: str) -> bytes:
        latin = LATIN.fullmatch(text)
        text = text.lower() if latin else text
        if (got := self.parts.get(text)) is None:
            ids = [t.id for t in self.model.tokenize(text.translate(self.table))] if latin else self.tokenizer.encode(text, add_special_tokens=False).ids
            got = array.array("i", ids).tobytes()
            if len(self.parts) < REMEMBERED:
                self.parts[text] = got
        return got

    def cuts_after(self, letters: str) -> bool:
        """Whether the normalized letters end in a letter or number, so that a sign after them starts a new part."""
        if LATIN.fullmatch(letters):
            return True
        ends = self.tokenizer.normalizer.normalize_str(letters)[-1:]
        return bool(ends) and unicodedata.category(ends)[0] in "LN"

    def __missing__(self, word: str) -> bytes:
        self.made += 1
        if self.made > STALE:
            self.made = 0
            self.clear()
            self.parts.clear()
        m = LETTERS_FIRST.fullmatch(word)
        got = self.part(m[1]) + self.part(m[2]) if m and self.cuts_after(m[1]) else self.part(word)
        if len(self) < REMEMBERED:
            self[word] = got
        return got

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, (text or "").replace("\n", " ").split(" "))), "<i4")


@functools.cache
def words_of(file: str) -> Words:
    """One per worker process and file: a worker keeps what it has met from task to task."""
    return Words(file)


class SumOfSquares:
    """Online packer. level[h] counts the open windows filled to h; an item of size s goes to the level where the sum
    of the squared counts grows least (a tie: the fullest). Full windows leave the array at once. When more than
    `most_open` are open, they are refilled from each other and one at most stays open."""

    def __init__(self, window: int, emit: Callable[[list], None], most_open: int = MOST_OPEN):
        self.window, self.emit, self.most_open = window, emit, most_open
        self.level = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list]] = {}
        self.count = self.refilled = 0

    def put(self, item: tuple, size: int) -> None:
        level, full = self.level, self.window
        if size == full:
            self.emit([item])
            return
        # growth of the sum for each start level h: h loses a window, h + size gains one, unless it is then full
        have = np.flatnonzero(level[1 : full - size + 1]) + 1
        best, cost = 0, 2 * level[size] + 1
        if len(have):
            after = have + size
            growth = np.where(after < full, 2 * level[after] + 1, 0) + (1 - 2 * level[have])
            k = len(growth) - 1 - int(np.argmin(growth[::-1]))
            if growth[k] <= cost:
                best = int(have[k])
        if best:
            level[best] -= 1
            held = self.open[best].pop()
            self.count -= 1
        else:
            held = []
        held.append(item)
        if best + size == full:
            self.emit(held)
        else:
            self.keep(held, best + size)
            if self.count > self.most_open:
                self.refill(False)

    def keep(self, held: list, filled: int) -> None:
        self.level[filled] += 1
        self.open.setdefault(filled, []).append(held)
        self.count += 1

    def close(self) -> None:
        """No item comes any more."""
        self.refill(True)

    def refill(self, last: bool) -> None:
        """Open windows are refilled from each other: items are cut where a window is full. What is left over stays
        open, or if it is the last time ends at powers of two."""
        rest = [item for h in sorted(self.open, reverse=True) for held in self.open[h] for item in held]
        total = sum(len(i[2]) for i in rest)
        self.level[:] = 0
        self.open.clear()
        self.count = 0
        over = total % self.window
        sizes = [self.window] * (total // self.window)
        sizes += [1 << k for k in reversed(range(self.window.bit_length())) if over >> k & 1] if last else [over] if over else []
        self.refilled += len(sizes) - (not last and over > 0)
        held, room, todo = [], 0, iter(sizes)
        for doc, start, ids, n in rest:
            while len(ids):
                if not room:
                    room = size = next(todo)
                held.append((doc, start, ids[:room], n))
                start, room, ids = start + len(held[-1][2]), room - len(held[-1][2]), ids[room:]
                if not room:
                    if size < self.window and not last:
                        self.keep(held, size)
                    else:
                        self.emit(held)
                    held = []


def pack_documents(docs: DataFrame, tokenizer_file: str, window: int = WINDOW, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and (with_ids) ids.

    A document's tokens are its text's ids and then end_id. Tokens beyond full windows form the rest, which is placed
    whole by sum-of-squares; windows are refilled by cutting when a partition ends, or when more than MOST_OPEN of them
    are open, so every sequence has `window` tokens or, for one remainder per partition, a power of two.

    Every partition packs on its own: nothing is shuffled and sequence_id is (partition << 33) + number, so a task
    that runs again makes the same rows if its input partition keeps its rows and order, as stored tables do. Open
    windows hold at most MOST_OPEN x window tokens. Null or empty text: end_id alone. Null and repeated doc_ids are
    packed like others; other columns are ignored; equal sizes are placed in the order of their rows. The ids of one
    text, however long, are in memory at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept("words")
        keeps("words", words_of.cache_clear)
        tokens, made = words_of(tokenizer_file), []
        number, held = TaskContext.get().partitionId() << 33, 0

        def emit(items: list) -> None:
            nonlocal number, held
            offset = 0
            for doc, start, ids, n in items:
                made.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), n, number, offset, ids if with_ids else None))
                offset += len(ids)
            number += 1
            held += offset

        def batch() -> pa.RecordBatch:
            nonlocal held
            held = 0
            cols = list(zip(*made, strict=True)) or [[]] * 8
            made.clear()
            kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], names)

        packer = SumOfSquares(window, emit)
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = np.append(tokens.ids(text), np.int32(end_id)).astype("<i4")
                whole = len(ids) // window * window
                for at in range(0, whole, window):
                    packer.put((doc, at, ids[at : at + window], len(ids)), window)
                if whole < len(ids):
                    packer.put((doc, whole, ids[whole:].copy(), len(ids)), len(ids) - whole)
                if len(made) >= 20_000 or with_ids and held >= BATCH_IDS:
                    yield batch()
        packer.close()
        yield batch()

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    out = small_batches(docs).selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"`{text_col}` text").mapInArrow(run, SCHEMA)
    return out if with_ids else out.drop("ids")
