"""Encoding texts with a public byte-level BPE vocabulary, and decoding ids."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the vocabulary files; a parameter of every operator here.
TOKENIZER_DIR = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
RANK_FILE = "byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits a text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of text that are encoded at once.
CHUNK = 1 << 16
_BOUNDARY = re.compile(r"(?<=\S)(?=\s)")


@lru_cache(maxsize=4)
def encoding(rank_file: str):
    """The tiktoken encoding of a local rank file (once per worker process)."""
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(os.path.basename(rank_file), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, chunk: int = CHUNK) -> Iterator[str]:
    """Cut a long text at safe boundaries, about every ``chunk`` characters.

    A cut stands between a character that is no white space and white space: no piece of
    the pattern crosses it and no lookahead of the pattern sees past it, so the pieces'
    ids, one after the other, are the text's. A run without such a place stays whole.
    """
    at = 0
    while len(text) - at > chunk:
        cut = _BOUNDARY.search(text, at + chunk)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def encode(text: str | None, rank_file: str) -> np.ndarray:
    """The ids of a text as numbers; none for a null or empty text."""
    if not text:
        return np.empty(0, np.uint32)
    e = encoding(rank_file)
    if len(text) <= CHUNK:
        return e.encode_to_numpy(text, disallowed_special=())
    return np.concatenate([e.encode_to_numpy(p, disallowed_special=()) for p in pieces(text)])


def encode_texts(df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """(key, ids array<int>): the ids of every text, without special tokens.

    Null and empty texts give an empty list, blank ones the ids of their white space;
    strings that look like special tokens are ordinary text. Repeated rows and null keys
    are kept. Whole texts are encoded, long ones in pieces. One pass, no shuffle.
    """
    rank_file = os.path.join(tokenizer_dir, RANK_FILE)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [encode(t, rank_file) for t in b.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, made)]).astype(np.int32)
            flat = pa.array(np.concatenate([np.empty(0, np.uint32), *made]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends), flat)], [key, "ids"])

    src = df.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text))
    return src.mapInArrow(work, f"`{key}` long, ids array<int>")


def decode_ids(df: DataFrame, key: str = "doc_id", ids: str = "ids", tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """(key, raw binary, text string): the bytes that the ids stand for, and their text.

    The bytes are exact for any ids, also where a character is cut; text replaces what is
    no UTF-8. Null or empty lists give empty bytes.
    """
    rank_file = os.path.join(tokenizer_dir, RANK_FILE)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoding(rank_file)
        for b in batches:
            raw = [e.decode_bytes(x or []) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary()), pa.array([r.decode("utf-8", "replace") for r in raw], pa.string())], [key, "raw", "text"])

    return df.select(F.col(key).cast("long").alias(key), ids).mapInArrow(work, f"`{key}` long, raw binary, text string")
