"""Byte-level BPE: texts to token ids and back, with tiktoken and a local rank file.

Null texts count as empty and give no ids. A text of any length is cut at places where the splitting
pattern always ends a match, so its ids are those of the whole text. Repeated rows are encoded each;
an empty table gives an empty result. A new column replaces an input column of the same name.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf

from tillgrain.llm.tables import query, table, whole_text

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
CHUNK = 1 << 16
#: Beyond so many characters without a safe place the matches are found one by one.
LONG_RUN = 1 << 18
#: No match of the pattern goes on from an ASCII letter or digit into white space, and what follows
#: is matched without a look back.
SAFE = re.compile(r"[A-Za-z0-9](?=[ \n])")
MATCH = regex.compile(public_tokenizers.PATTERN)


@lru_cache(maxsize=4)
def encoding(rank_file: str) -> tiktoken.Encoding:
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def pieces(text: str) -> Iterator[str]:
    """The text in order, cut only at safe places."""
    at = 0
    while len(text) - at > CHUNK:
        found = SAFE.search(text, at + CHUNK)
        end = found.end() if found else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def encode_text(text: str, rank_file: str = RANKS) -> list[int]:
    codec = encoding(rank_file)
    if len(text) <= CHUNK:
        return codec.encode_ordinary(text)
    ids: list[int] = []
    for piece in pieces(text):
        if len(piece) <= LONG_RUN:
            ids += codec.encode_ordinary(piece)
        else:
            for match in MATCH.finditer(piece):
                ids += codec._encode_single_piece(match.group())
    return ids


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return np.asarray(ids, dtype="<u4").tobytes()


def _encoder(rank_file: str, as_bytes: bool):
    @arrow_udf("binary" if as_bytes else "array<int>")
    def encode_batch(texts: pa.Array) -> pa.Array:
        # Packed at once: lists of Python integers would take ten times the room.
        rows = [packed(encode_text(t.as_py() or "", rank_file)) for t in texts]
        if as_bytes:
            return pa.array(rows, pa.binary())
        ends = np.cumsum([0, *map(len, rows)]) // 4
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                        pa.array(np.frombuffer(b"".join(rows), "<i4")))

    return encode_batch


def _decoder(rank_file: str):
    @arrow_udf("binary")
    def decode_batch(ids: pa.Array) -> pa.Array:
        codec = encoding(rank_file)
        lists = (np.frombuffer(x.as_py() or b"", "<u4").tolist() if pa.types.is_binary(ids.type)
                 else x.as_py() or [] for x in ids)
        return pa.array((codec.decode_bytes(x) for x in lists), pa.binary())

    return decode_batch


def encode(docs: DataFrame, text: str = "text", into: str = "ids", rank_file: str = RANKS,
           as_bytes: bool = False) -> DataFrame:
    """Add the ids of every text: an array of int, or with ``as_bytes`` the packed integers."""
    return docs.withColumn(into, _encoder(rank_file, as_bytes)(whole_text(text)))


def decode(tokens: DataFrame, ids: str = "ids", into: str = "decoded",
           rank_file: str = RANKS) -> DataFrame:
    """Add the raw bytes that the ids stand for; they need not be whole characters."""
    return tokens.withColumn(into, _decoder(rank_file)(F.col(f"`{ids}`")))


def digest(column: str) -> Column:
    return F.sha2(F.col(column), 256)


@query("op1_byte_bpe")
def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = decode(encode(docs, as_bytes=True))
    return coded.select(
        "doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        digest("ids").alias("ids_sha256"), digest("decoded").alias("decoded_sha256"))
