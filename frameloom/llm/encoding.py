"""Encoding of the whole corpus with a public tokenizer (problem 7).

Texts go through the tokenizers library in Arrow batches. Byte-level BPE writes each byte as a printable character; ``byte_table``
is that mapping, ``token_bytes`` its inverse for a vocabulary, and offsets and decoding are worked out on bytes, so that tokens
that split a character are handled.
"""

from __future__ import annotations

import codecs
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FOLDER = "/opt/tokenizers"
#: Characters of text in one call of the tokenizer, which bounds the memory of its results.
CHUNK = 400_000


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    t.no_padding()
    t.no_truncation()
    return t


@lru_cache(maxsize=1)
def byte_table() -> dict[str, int]:
    """Printable character to byte: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def token_bytes(path: str) -> tuple[bytes, ...]:
    """The bytes of each id; an id without a token has none."""
    table, vocabulary = byte_table(), tokenizer(path).get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
    return tuple(out)


def batch_ids(path: str, texts: list[str | None]) -> list[list[int]]:
    """Ids of each text; null and empty texts have none."""
    t, out, lo = tokenizer(path), [], 0
    texts = [x or "" for x in texts]
    while lo < len(texts):
        hi, chars = lo, 0
        while hi < len(texts) and (hi == lo or chars + len(texts[hi]) <= CHUNK):
            chars += len(texts[hi])
            hi += 1
        out += [e.ids for e in t.encode_batch_fast(texts[lo:hi], add_special_tokens=False)]
        lo = hi
    return out


def offsets(text: str, ids: list[int], table: tuple[bytes, ...]) -> list[tuple[int, int]]:
    """First character and end of each token. A token that holds part of a character counts with the whole of it."""
    raw = np.frombuffer(text.encode(), np.uint8)
    # the number of characters that begin at or before each byte
    begun = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    ends = np.cumsum([len(table[i]) for i in ids], dtype=np.int64)
    starts = np.concatenate(([0], ends[:-1])) if len(ids) else ends
    return [(int(begun[min(s + 1, len(raw))]) - 1, int(begun[e])) for s, e in zip(starts, ends)]


def decode(ids: Iterable[int], table: tuple[bytes, ...]) -> str:
    """The text of ids. Bytes that make no character, as where a cut splits one, come out as U+FFFD."""
    return b"".join(table[i] for i in ids).decode("utf-8", "replace")


def decode_stream(parts: Iterable[Iterable[int]], table: tuple[bytes, ...]) -> Iterator[str]:
    """The text of each part of a sequence; the bytes of a split character come out with the part that completes it."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for part in parts:
        yield decoder.decode(b"".join(table[i] for i in part))
    if rest := decoder.decode(b"", final=True):
        yield rest


def _path(name: str, folder: str) -> str:
    return f"{folder}/{name}.json"


def encode_documents(documents: DataFrame, name: str = "byte_bpe_50k", folder: str = FOLDER) -> DataFrame:
    """doc_id, ids of every document, without special tokens; their strings in a text are ordinary text.

    Null and empty texts have an empty list. Rows are kept as they are: a repeated or null doc_id comes out as often.
    """
    path = _path(name, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                part = b.slice(lo, 2048)
                ids = batch_ids(path, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def encode_with_offsets(documents: DataFrame, name: str = "byte_bpe_50k", folder: str = FOLDER) -> DataFrame:
    """doc_id, ids, starts, ends: as ``encode_documents``, with the characters of the text that each token covers."""
    path = _path(name, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(path)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                texts = part.column(1).to_pylist()
                ids = batch_ids(path, texts)
                at = [offsets(t or "", i, table) for t, i in zip(texts, ids)]
                columns = [ids, [[s for s, _ in x] for x in at], [[e for _, e in x] for x in at]]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, pa.list_(pa.int32())) for c in columns)], ["doc_id", "ids", "starts", "ends"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode_documents(encoded: DataFrame, name: str = "byte_bpe_50k", folder: str = FOLDER) -> DataFrame:
    """doc_id, text of rows of ids; no ids give an empty text, null ids a null text."""
    path = _path(name, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(path)
        for b in batches:
            texts = [None if x is None else decode(x, table) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")
