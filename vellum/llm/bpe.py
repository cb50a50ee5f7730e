"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

Texts are encoded whole.  A long text is first cut where the pre-splitting
pattern must break in any case: between a character that is no white space
and a following blank or newline.  No match of the pattern spans such a place
and its only look-ahead, ``\\s+(?!\\S)``, never ends there, so the ids of the
pieces joined are the ids of the whole.  Where a long stretch has no such
place, its matches are found one by one and encoded singly.

Defined results: a null text counts as empty (no ids); repeated rows give
repeated results; an empty table gives an empty table; other columns of the
input are not read.
"""

from __future__ import annotations

import base64
import functools
import hashlib

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

#: Texts of more characters than this are cut at safe boundaries.
LONG = 1 << 15
#: A stretch without safe boundary that is longer is split by the pattern here.
GIANT = 1 << 18
SAFE = regex.compile(r"(?<=[^\s\x1c-\x1f])(?=[ \n])")
#: White space as the Unicode property has it; ``regex`` adds \x1c-\x1f.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

IDS_SCHEMA = "doc_id bigint, ids array<int>"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f) if token}


@functools.lru_cache(maxsize=4)
def codec(rank_path: str, pattern: str) -> Codec:
    """One codec a Python worker."""
    return Codec(rank_path, pattern)


class Codec:
    """tiktoken over a rank file, safe for texts of any length."""

    def __init__(self, rank_path: str, pattern: str):
        self.encoding = tiktoken.Encoding("vellum", pat_str=pattern, mergeable_ranks=load_ranks(rank_path), special_tokens={})
        explicit = pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")
        self.pattern = regex.compile(explicit)

    def pieces(self, text: str) -> Iterator[str]:
        """Cut at safe boundaries into pieces of about LONG characters."""
        at = 0
        while len(text) - at > LONG:
            found = SAFE.search(text, at + LONG)
            if not found:
                break
            yield text[at : found.start()]
            at = found.start()
        yield text[at:]

    def encode(self, text: str) -> list[int]:
        if len(text) <= LONG:
            return self.encoding.encode_ordinary(text)
        ids: list[int] = []
        for piece in self.pieces(text):
            if len(piece) <= GIANT:
                ids += self.encoding.encode_ordinary(piece)
            else:
                for found in self.pattern.finditer(piece):
                    ids += self.encoding._core_bpe.encode_single_piece(found[0].encode())
        return ids

    def decode(self, ids: list[int]) -> bytes:
        """The raw bytes; they need not be valid UTF-8 for arbitrary ids."""
        return self.encoding.decode_bytes(ids)


def encode(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """``docs(doc_id, text)`` to ``(doc_id, ids)``; no shuffle, one pass."""

    def run(batches):
        c = codec(rank_path, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                ids = [c.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(run, IDS_SCHEMA)


def decode(encoded: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids)`` to ``(doc_id, bytes)``; null ids give null bytes."""

    def run(batches):
        c = codec(rank_path, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                raw = [None if ids is None else c.decode(ids) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(raw, pa.binary())], ["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, bytes binary")


def digest(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """Encode, pack the ids as little-endian words, decode the packed ids, and
    return lengths and digests: a round trip in one pass."""

    def one(c: Codec, text: str) -> tuple[int, str, str]:
        packed = np.asarray(c.encode(text), "<u4").tobytes()
        back = c.decode(np.frombuffer(packed, "<u4").tolist())
        return len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(back).hexdigest()

    return per_text(docs, one, rank_path, pattern)


def per_text(docs: DataFrame, one: Callable, rank_path: str, pattern: str) -> DataFrame:
    def run(batches):
        c = codec(rank_path, pattern)
        for batch in batches:
            got = [one(c, t or "") for t in batch.column(1).to_pylist()] or []
            n, ids, raw = zip(*got, strict=True) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(raw, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")




