"""Byte-level BPE with tiktoken and a local rank file."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import small_batches

#: Characters of a text that tiktoken gets at once, at least; longer texts are cut at safe places only.
PIECE = 1 << 16


def encoding(rank_file: str, pattern: str):
    """tiktoken's encoding for a local file of base64 tokens and ranks; no special tokens."""
    import tiktoken

    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, most: int = PIECE) -> Iterator[str]:
    """Cut a text before a single space that stands between two characters that are no white space.

    The pattern's branches take a space only as the first character of a match, so no match spans such a place and
    the pieces' matches are the whole text's. A stretch without such a place stays whole."""
    start, n = 0, len(text)
    while n - start > most:
        cut = text.find(" ", start + most)
        while cut > 0 and (text[cut - 1].isspace() or cut + 1 >= n or text[cut + 1].isspace()):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, ids (array of int), decoded (the ids' raw bytes).

    Null text counts as empty: no ids, no bytes. Ids may be null or repeated; other columns are ignored. Nothing is
    shuffled; a task holds one Arrow batch of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for b in batches:
            ids, raw = [], []
            for text in b.column(1).to_pylist():
                got = [i for piece in safe_pieces(text or "") for i in enc.encode_ordinary(piece)]
                ids.append(got)
                raw.append(enc.decode_bytes(got))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(raw, pa.binary())], ["doc_id", "ids", "decoded"])

    return small_batches(docs).selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"`{text_col}` text").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def encode_digests(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of encode_documents without sending ids back to the JVM: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for b in batches:
            n, ids_sha, raw_sha = [], [], []
            for text in b.column(1).to_pylist():
                count, ids, raw = 0, hashlib.sha256(), hashlib.sha256()
                for piece in safe_pieces(text or ""):
                    if got := enc.encode_ordinary(piece):
                        ids.update(((" " if count else "") + " ".join(map(str, got))).encode())
                        raw.update(enc.decode_bytes(got))
                        count += len(got)
                n.append(count)
                ids_sha.append(ids.hexdigest())
                raw_sha.append(raw.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(raw_sha)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return small_batches(docs).selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"`{text_col}` text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
