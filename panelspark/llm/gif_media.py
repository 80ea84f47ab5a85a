"""GIF media columns: documents as frames of 8-bit samples, LZW code streams, palettes, disposal, timed frames.

Reading is done over many frames at once: the codes of all streams of a group become one array, in which a code's word
is the word of an earlier code and one more sample, so lengths and samples come from following those references."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

WIDTH = 192
#: Rows of 192 samples in one frame; bytes of code streams that are decoded together, about.
FRAME_ROWS, GROUP = 256, 1 << 18
CLEAR, END = 256, 257
#: Colour bins: two bits of red, green and blue each; the last one counts pixels that nothing has been drawn on.
BINS = 65
#: The palette of stored documents: three bits of red and green, two of blue.
PALETTE = np.array([(36 * (i >> 5), 36 * (i >> 2 & 7), 85 * (i & 3)) for i in range(256)], np.uint8)
DAMAGED = (ValueError, IndexError, struct.error)


def pack_codes(codes: np.ndarray, widths: np.ndarray) -> bytes:
    """Codes of the given bit widths, least significant bit first."""
    bits = np.unpackbits(codes.astype("<u2").view(np.uint8).reshape(-1, 2), axis=1, bitorder="little")
    return np.packbits(bits[np.arange(16) < widths[:, None]], bitorder="little").tobytes()


def code_widths(n: int, root: int = 8) -> np.ndarray:
    """Width of the i-th code after a clear code: the reader's table has (1 << root) + 1 + i entries before it."""
    last = np.minimum((1 << root) + 1 + np.arange(n), 4095)
    return np.maximum(root + 1, np.floor(np.log2(last)).astype(np.int64) + 1)


WIDTHS = {root: code_widths(1 << 13, root) for root in range(2, 9)}
ENDS = {root: np.cumsum(w) for root, w in WIDTHS.items()}


def lzw_encode(samples: bytes) -> bytes:
    """GIF's LZW with 8-bit roots: greedy longest phrases, a clear code when the table of 4096 is full."""
    codes: list[int] = [CLEAR << 8]
    widths = [np.array([9])]
    since = 1
    if samples:
        table: dict[int, int] = {}  # phrase << 8 | sample to longer phrase << 8
        free, prefix = 258 << 8, samples[0] << 8
        get, add = table.get, codes.append
        for b in samples[1:]:
            longer = get(prefix | b)
            if longer is not None:
                prefix = longer
                continue
            add(prefix)
            if free < 4096 << 8:
                table[prefix | b] = free
                free += 256
            else:
                add(CLEAR << 8)
                widths.append(WIDTHS[8][: len(codes) - since])
                since = len(codes)
                table.clear()
                free = 258 << 8
            prefix = b << 8
        add(prefix)
    codes.append(END << 8)
    widths.append(WIDTHS[8][: len(codes) - since])
    return pack_codes(np.array(codes) >> 8, np.concatenate(widths))


def read_codes(data: bytes, root: int) -> list[np.ndarray]:
    """The codes of a stream, one array for what stands between clear codes. Damaged streams raise ValueError."""
    clear, widths, ends = 1 << root, WIDTHS[root], ENDS[root]
    raw = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    parts, run = [], []
    at, total = 0, len(data) * 8
    while True:
        if run:  # the table is full: all codes have 12 bits
            n = min((total - at) // 12, len(widths))
            wide, stop_at = np.full(n, 12), at + 12 * np.arange(1, n + 1)
        else:
            n = int(np.searchsorted(ends, total - at, side="right"))
            wide, stop_at = widths[:n], at + ends[:n]
        if not n:
            raise ValueError("the code stream ends without its end code")
        start = stop_at - wide
        byte = start >> 3
        word = raw[byte] | raw[byte + 1] << 8 | raw[byte + 2] << 16
        codes = ((word >> (start & 7).astype(np.uint32)) & ((1 << wide) - 1).astype(np.uint32)).astype(np.int64)
        stop = np.flatnonzero((codes == clear) | (codes == clear + 1))
        if not len(stop):
            run.append(codes)
            at = int(stop_at[-1])
            continue
        k = int(stop[0])
        run.append(codes[:k])
        parts.append(np.concatenate(run))
        at, run = int(stop_at[k]), []
        if codes[k] == clear + 1:
            break
    for part in parts:
        back = part - clear - 2 - np.arange(len(part))
        if len(part) and (part[0] >= clear or ((part > clear) & (back >= 0)).any()):
            raise ValueError("a code points beyond the table")
    return parts


def lzw_decode(streams: list[tuple[bytes, int]]) -> list[np.ndarray | str]:
    """The samples of each (code stream, root bits), or what is wrong with it."""
    out: list[np.ndarray | str] = []
    parts: list[tuple[int, int, np.ndarray]] = []
    for i, (data, root) in enumerate(streams):
        try:
            if not 2 <= root <= 8:
                raise ValueError("roots have 2 to 8 bits")
            parts += [(i, root, p) for p in read_codes(data, root) if len(p)]
            out.append(np.zeros(0, np.uint8))
        except ValueError as e:
            out.append(str(e))
    parts = [p for p in parts if not isinstance(out[p[0]], str)]
    if not parts:
        return out
    sizes = np.array([len(p[2]) for p in parts])
    base = np.repeat(np.cumsum(sizes) - sizes, sizes)
    first = np.repeat([(1 << p[1]) + 2 for p in parts], sizes)
    code = np.concatenate([p[2] for p in parts])
    own = np.arange(len(code))
    longer = code >= first
    # a code's word is that of the code it refers to, and the first sample of the code after that one
    parent = np.where(longer, base + code - first, own)
    depth, root_of = longer.astype(np.int64), parent
    while depth[root_of].any():
        depth = depth + depth[root_of]
        root_of = root_of[root_of]
    last = np.where(longer, code[root_of[np.minimum(parent + longer, len(code) - 1)]], code).astype(np.uint8)
    at = np.cumsum(depth + 1) - 1  # where the last sample of each word goes
    samples = np.empty(int(at[-1]) + 1, np.uint8)
    here = own
    while len(here):
        samples[at] = last[here]
        more = np.flatnonzero(longer[here])
        here, at = parent[here[more]], at[more] - 1
    ends = np.cumsum(depth + 1)[np.cumsum(sizes) - 1]
    start = 0
    for (i, _, _), end in zip(parts, ends.tolist(), strict=True):
        out[i] = samples[start:end] if not len(out[i]) else np.concatenate([out[i], samples[start:end]])
        start = end
    return out


def blocks(data: bytes) -> bytes:
    """Data as GIF sub-blocks."""
    return b"".join(bytes([len(data[i : i + 255])]) + data[i : i + 255] for i in range(0, len(data), 255)) + b"\0"


def write_gif(samples: bytes, width: int = WIDTH, rows: int = FRAME_ROWS, delay: int = 4, palette: np.ndarray = PALETTE) -> bytes:
    """Samples (a positive multiple of width) as a GIF of timed frames; a frame stays until the next is drawn on it."""
    height = min(rows, len(samples) // width)
    out = [b"GIF89a", struct.pack("<HHBBB", width, height, 0xF7, 0, 0), palette.tobytes()]
    for at in range(0, len(samples), width * rows):
        frame = samples[at : at + width * rows]
        out += [b"\x21\xf9\x04", struct.pack("<BHB", 1 << 2, delay, 0), b"\0", b"\x2c", struct.pack("<HHHHB", 0, 0, width, len(frame) // width, 0), b"\x08", blocks(lzw_encode(frame))]
    return b"".join(out) + b"\x3b"


def parse_gif(data: bytes) -> tuple[int, int, list[dict]]:
    """Width, height and frames of a GIF, not yet decoded: box (left, top, width, height), delay in 1/100 s, at (when it
    is shown), disposal, transparent (index or None), interlaced, palette (colours x 3), root, stream.

    A file without a GIF's signature, without its end mark or cut inside raises one of DAMAGED."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags, _, _ = struct.unpack("<HHBBB", data[6:13])
    at, palette = 13, None

    def colours(bits: int, at: int) -> tuple[np.ndarray, int]:
        n = 3 << bits + 1
        return np.frombuffer(data[at : at + n], np.uint8).reshape(2 << bits, 3), at + n

    def joined(at: int) -> tuple[bytes, int]:
        parts = []
        while n := data[at]:
            parts.append(data[at + 1 : at + 1 + n])
            at += 1 + n
        return b"".join(parts), at + 1

    if flags & 0x80:
        palette, at = colours(flags & 7, at)
    frames: list[dict] = []
    delay, disposal, transparent, time = 0, 0, None, 0
    while data[at] != 0x3B:
        if data[at] == 0x21:
            if data[at + 1] == 0xF9:
                bits, delay, index = struct.unpack("<BHB", data[at + 3 : at + 7])
                disposal, transparent = bits >> 2 & 7, index if bits & 1 else None
            _, at = joined(at + 2)
            continue
        if data[at] != 0x2C:
            raise ValueError("an unknown block")
        left, top, w, h, bits = struct.unpack("<HHHHB", data[at + 1 : at + 10])
        at, own = at + 10, palette
        if bits & 0x80:
            own, at = colours(bits & 7, at)
        if own is None:
            raise ValueError("a frame without a palette")
        root = data[at]
        stream, at = joined(at + 1)
        frames.append({"box": (left, top, w, h), "delay": delay, "at": time, "disposal": disposal, "transparent": transparent, "interlaced": bool(bits & 0x40), "palette": own, "root": root, "stream": stream})
        time += delay
        delay, disposal, transparent = 0, 0, None
    return width, height, frames


def grids(frames: Iterator[tuple[int, dict]]) -> Iterator[tuple[int, dict, np.ndarray | str]]:
    """(key, frame, its samples as rows x columns, or what is wrong), decoding streams of about GROUP bytes together."""
    held: list[tuple[int, dict]] = []
    size = 0

    def flush() -> Iterator[tuple[int, dict, np.ndarray | str]]:
        nonlocal size
        for (key, f), got in zip(held, lzw_decode([(f["stream"], f["root"]) for _, f in held]), strict=True):
            w, h = f["box"][2:]
            if not isinstance(got, str) and len(got) != w * h:
                got = "a frame has another number of samples"
            if not isinstance(got, str):
                got = got.reshape(h, w)
                if f["interlaced"]:  # every 8th row, then those between
                    order = [*range(0, h, 8), *range(4, h, 8), *range(2, h, 4), *range(1, h, 2)]
                    got = got[np.argsort(order)]
            yield key, f, got
        held.clear()
        size = 0

    for key, f in frames:
        held.append((key, f))
        size += len(f["stream"])
        if size >= GROUP:
            yield from flush()
    yield from flush()


class Canvas:
    """What a GIF shows: frames drawn over each other under the rules of transparency and disposal.

    A pixel is a row of `table`, which holds one for each palette index, and `empty` where nothing is drawn."""

    def __init__(self, height: int, width: int, empty: np.ndarray):
        self.empty = empty
        self.pixels = np.broadcast_to(empty, (height, width, *empty.shape)).copy()
        self.after = None

    def draw(self, frame: dict, grid: np.ndarray, table: np.ndarray) -> np.ndarray:
        """The canvas with a frame on it; disposing of the frame before comes first."""
        if self.after:
            self.after()
        left, top, w, h = frame["box"]
        box = self.pixels[top : top + h, left : left + w]
        part = grid[: box.shape[0], : box.shape[1]]
        old = box.copy() if frame["disposal"] == 3 else self.empty if frame["disposal"] == 2 else None

        def dispose() -> None:
            box[...] = old

        self.after = None if old is None else dispose
        if frame["transparent"] is None:
            box[...] = table[part]
        else:
            keep = part != frame["transparent"]
            box[keep] = table[part[keep]]
        return self.pixels


def padded(table: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """A table of 256 rows; indices beyond a palette are drawn as `rest`."""
    return np.concatenate([table, np.broadcast_to(rest, (256 - len(table), *rest.shape))]) if len(table) < 256 else table


def colour_bins(palette: np.ndarray) -> np.ndarray:
    """The bin of each palette colour: two bits of red, green and blue each."""
    high = palette >> 6
    return (high[:, 0] << 4 | high[:, 1] << 2 | high[:, 2]).astype(np.uint8)


def read_gif(data: bytes) -> tuple[int, int, list[dict]]:
    """Width, height and frames of a GIF, decoded: those of parse_gif() with samples (rows x columns) and canvas
    (height x width x 4 RGBA after drawing it). Damaged files raise one of DAMAGED."""
    width, height, frames = parse_gif(data)
    canvas, out = Canvas(height, width, np.zeros(4, np.uint8)), []
    for _, f, grid in grids((0, f) for f in frames):
        if isinstance(grid, str):
            raise ValueError(grid)
        table = padded(np.column_stack([f["palette"], np.full(len(f["palette"]), 255, np.uint8)]), np.array([0, 0, 0, 255], np.uint8))
        out.append({**f, "samples": grid, "canvas": canvas.draw(f, grid, table).copy()})
    return width, height, out


def payload(text: str | None) -> tuple[int, bytes]:
    """Bytes of a text, and the text padded with spaces to a positive multiple of 192."""
    raw = (text or "").encode()
    return len(raw), raw + b" " * (WIDTH - len(raw) if len(raw) < WIDTH else -len(raw) % WIDTH)


def store_as_gif(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, media (the GIF file). Null text counts as empty: one row of spaces.

    Ids may be null or repeated; other columns are ignored. A text of any length becomes one file, frame by frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                made = [payload(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([n for n, _ in made], pa.int64()), pa.array([write_gif(p) for _, p in made], pa.binary())], ["doc_id", "n_bytes", "media"])

    return small_batches(docs).selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"`{text_col}` text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


FRAME = "struct<at: bigint, delay: int, disposal: int, colours: array<int>>"


def gif_features(media: DataFrame) -> DataFrame:
    """Decode the media column of store_as_gif(): doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32,
    media_bytes, media_sha256, feature, frames, error.

    frames: when each frame is shown and for how long (1/100 s), its disposal, and the colour histogram of the canvas
    with it drawn (BINS counts). feature: number of frames, play time, height, histogram over the shown frames
    (`bin:count` where not 0). A null media value gives nulls in all but the first two. A damaged file gives its
    media_bytes and media_sha256, what is wrong as error, and nulls else. One group of streams and one canvas are in
    memory at a time, however long the file."""
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "frames", "error"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    frame_type = pa.struct([("at", pa.int64()), ("delay", pa.int32()), ("disposal", pa.int32()), ("colours", pa.list_(pa.int32()))])

    def described(files: list[bytes | None]) -> tuple[list[tuple], pa.Array, list[str | None]]:
        state: list[dict | None] = []
        for file in files:
            got = None
            if file is not None:
                got = {"bytes": len(file), "sha": hashlib.sha256(file).hexdigest(), "error": None, "frames": [], "shown": [], "size": 0, "tail": b"", "digest": hashlib.sha256(), "canvas": None, "height": 0}
                try:
                    width, got["height"], got["frames"] = parse_gif(file)
                    got["canvas"] = Canvas(got["height"], width, np.array(BINS - 1, np.uint8)) if got["frames"] else None
                except DAMAGED as e:
                    got["error"], got["frames"] = str(e), []
            state.append(got)
        for i, f, grid in grids((i, f) for i, s in enumerate(state) if s for f in s["frames"]):
            s = state[i]
            if s["error"] or isinstance(grid, str):
                s["error"] = s["error"] or grid
                continue
            raw = grid.tobytes()
            s["digest"].update(raw)
            s["size"], s["tail"] = s["size"] + len(raw), (s["tail"] + raw[-16:])[-16:]
            canvas = s["canvas"].draw(f, grid, padded(colour_bins(f["palette"]), np.array(0, np.uint8)))
            s["shown"].append(np.bincount(canvas.ravel(), minlength=BINS))
        rows, flat, sizes, void = [], [], [], []
        for s in state:
            fine = s is not None and not s["error"]
            void.append(not fine)
            sizes.append(len(s["shown"]) if fine else 0)
            if not fine:
                rows.append((None,) * 3 + ((None, None) if s is None else (s["bytes"], s["sha"])) + (None,))
                continue
            flat += [(f, c) for f, c in zip(s["frames"], s["shown"], strict=True)]
            counts = np.sum(s["shown"], axis=0) if s["shown"] else np.zeros(BINS, np.int64)
            hist = ",".join(f"{k}:{counts[k]}" for k in np.flatnonzero(counts))
            feature = f"frames={len(s['frames'])};time={sum(f['delay'] for f in s['frames'])};height={s['height']};colours={hist}"
            rows.append((s["size"], s["digest"].hexdigest(), zlib.crc32(s["tail"]), s["bytes"], s["sha"], feature))
        counts = np.concatenate([c for _, c in flat]).astype(np.int32) if flat else np.zeros(0, np.int32)
        colours = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * BINS, pa.int32()), pa.array(counts))
        plain = [pa.array([f[k] for f, _ in flat], t) for k, t in (("at", pa.int64()), ("delay", pa.int32()), ("disposal", pa.int32()))]
        each = pa.StructArray.from_arrays([*plain, colours], fields=list(frame_type))
        frames = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), each, mask=pa.array(void))
        return rows, frames, [s and s["error"] for s in state]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                rows, frames, errors = described(part.column(2).to_pylist())
                cols = list(zip(*rows, strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(list(r), t) for r, t in zip(cols, kinds, strict=True)), frames, pa.array(errors, pa.string())], names)

    schema = f"doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, frames array<{FRAME}>, error string"
    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, schema)


def timed_frames(features: DataFrame) -> DataFrame:
    """One row per frame of gif_features(): doc_id, frame, at, delay, disposal, and a column for each colour bin."""
    each = features.select("doc_id", F.posexplode("frames").alias("frame", "f"))
    return each.select("doc_id", "frame", "f.at", "f.delay", "f.disposal", *[F.col("f.colours")[k].alias(f"colour_{k}") for k in range(BINS - 1)], F.col("f.colours")[BINS - 1].alias("undrawn"))
