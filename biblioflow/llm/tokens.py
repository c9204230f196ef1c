"""Corpus encoding with a public byte-level BPE (problem 8)."""

from __future__ import annotations

import base64
import re
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Directory of the vocabulary files; a parameter of every operator here.
TOKENIZERS = "/opt/tokenizers"
PIECE = 20_000
# A single blank between a non-blank and a letter or digit always starts a pre-token.
SAFE = re.compile(r"(?<=\S) (?=[^\W_])")
# Fixed value: the pre-tokenizer pattern that the vocabulary was made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def encoder(name: str = "byte_bpe_50k", folder: str = TOKENIZERS):
    import tiktoken

    ranks = {}
    for line in Path(folder, f"{name}.tiktoken").read_bytes().splitlines():
        token, _, rank = line.partition(b" ")
        if rank:
            ranks[base64.b64decode(token)] = int(rank)
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, size: int = PIECE) -> list[str]:
    """Cut a long text at boundaries that no pre-token crosses; short texts stay whole."""
    if len(text) <= size:
        return [text]
    out, at = [], 0
    while len(text) - at > size:
        m = SAFE.search(text, at + size)
        if not m:
            break
        out.append(text[at : m.start()])
        at = m.start()
    out.append(text[at:])
    return out


def encode(text: str | None, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> list[int]:
    """Ids of a text without special tokens; null and empty give an empty list."""
    if not text:
        return []
    enc = encoder(name, folder)
    if len(text) <= PIECE:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for piece in safe_pieces(text):
        ids += enc.encode_ordinary(piece)
    return ids


def decode(ids: list[int], name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> bytes:
    """The raw bytes that the ids stand for (pieces may cut a character)."""
    return encoder(name, folder).decode_bytes(ids)


def encode_corpus(df: DataFrame, key: str, text: str, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """One row per row of ``df``: the key and ``ids`` (array of int).

    No shuffle; each batch is encoded where it is read. Null and empty texts give
    an empty array, special-token strings count as ordinary text, an empty table
    gives an empty table. Other columns of ``df`` are not read.
    """

    def run(batches):
        enc = encoder(name, folder)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids, sizes = [], np.zeros(len(texts) + 1, np.int64)
            for i, t in enumerate(texts):
                got = () if not t else enc.encode_ordinary(t) if len(t) <= PIECE else encode(t, name, folder)
                ids.append(np.array(got, np.int32))
                sizes[i + 1] = len(got)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["key", "ids"])

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, ids array<int>")
    return out.withColumnRenamed("key", key)
