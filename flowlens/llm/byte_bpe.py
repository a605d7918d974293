"""Byte-level BPE encoding and decoding (operator 1), with the tokenizers library.

A rank file (token bytes, rank) is turned into a vocabulary over the printable
byte alphabet and the merges that build each token.  Texts are encoded in
Arrow batches; offsets are byte spans of each token and the characters they
touch.  Decoding looks every id up in the reversed byte table; characters
split over several tokens are put together over the joined bytes.

Defined cases: a null text counts as empty and gives no ids; lone surrogates
cannot occur in Arrow strings; unknown ids fail the job; very long texts are
one row like any other; repeated rows are returned once each; further columns
are ignored unless named.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, IntegerType, StructField, StructType)
from tokenizers import models

from flowlens.llm.common import batch, prepare


def byte_characters() -> list[str]:
    """Printable character of each byte: itself where printable, the others
    numbered from 256 up (fixed rule of byte-level vocabularies)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in table:
            table[b], extra = chr(extra), extra + 1
    return [table[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


def merge_parts(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two tokens whose merge makes ``token``: run the merges of lower
    rank over its bytes."""
    parts, own = [token[i:i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        best, at = own, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1], own)
            if r < best:
                best, at = r, i
        if at < 0:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    if len(parts) != 2:
        raise ValueError(f"token {token!r} has no merge")
    return parts[0], parts[1]


@functools.lru_cache(maxsize=2)
def spelled_ranks(path: str) -> dict[str, int]:
    """The vocabulary with every byte written as its character."""
    chars = byte_characters()
    return {"".join([chars[b] for b in t]): r for t, r in read_ranks(path).items()}


#: Unicode White_Space, what \\s means in the split patterns (fixed values)
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class Memory(dict):
    """Remembers ``make(key)`` for short keys in two generations of at most
    ``limit`` entries: keys in use move to the young one, the old one goes."""

    def __init__(self, make, limit: int, longest: int):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            self[key] = value
        return value

    def age(self) -> None:
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()


class PieceEncoder:
    """Splits texts by ``pattern`` and encodes every match by itself with the
    tokenizers library.  Texts are first cut where white space follows other
    characters; no match of a byte-level pattern goes over such a place, so the
    ids of a chunk (a word with what stands before and after it) depend on the
    chunk alone and short chunks and matches are remembered."""

    def __init__(self, path: str, pattern: str, limit: int = 100_000, longest: int = 48):
        ranks, chars = read_ranks(path), byte_characters()
        order = sorted((t for t in ranks if len(t) > 1), key=ranks.__getitem__)
        merges = [tuple("".join([chars[b] for b in p]) for p in merge_parts(t, ranks))
                  for t in order]
        tokenize = models.BPE(vocab=spelled_ranks(path), merges=merges, cache_capacity=0).tokenize
        spell = dict(enumerate(chars))
        ints = list(range(max(ranks.values()) + 1))  # one object per id
        matches = regex.compile(pattern).findall

        def encode_match(piece: str) -> tuple[int, ...]:
            """Its bytes as characters, merged by the library."""
            return tuple([ints[t.id] for t in
                          tokenize(piece.encode().decode("latin-1").translate(spell))])

        self.words = Memory(encode_match, limit, longest)
        word = self.words.__getitem__
        self.known = Memory(lambda c: tuple(chain.from_iterable(map(word, matches(c)))),
                            limit, longest)
        self.chunks = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+").findall

    def encode(self, text: str) -> list[int]:
        self.words.age()
        self.known.age()
        return list(chain.from_iterable(map(self.known.__getitem__, self.chunks(text))))


@functools.lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> PieceEncoder:
    """Built once per Python worker."""
    return PieceEncoder(path, pattern)


@functools.lru_cache(maxsize=2)
def byte_table(path: str) -> list[bytes]:
    """Bytes of each id, through the reversed byte alphabet."""
    back = {c: b for b, c in enumerate(byte_characters())}
    vocab = spelled_ranks(path)
    table = [b""] * (max(vocab.values()) + 1)
    for spelled, i in vocab.items():
        table[i] = bytes([back[c] for c in spelled])
    return table


def encode_texts(texts: list[str], path: str, pattern: str) -> list[list[int]]:
    return list(map(encoder(path, pattern).encode, texts))


def decode_ids(ids, path: str) -> bytes:
    return b"".join(map(byte_table(path).__getitem__, ids))


def token_offsets(ids, text: str, path: str) -> tuple[list[int], list[int], list[int], list[int]]:
    """Byte start and end of each token, and the first and last-plus-one
    character it touches (tokens that share a split character overlap)."""
    table = byte_table(path)
    ends = np.cumsum([len(table[i]) for i in ids], dtype=np.int64)
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    lead = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
    char_of = np.concatenate((np.cumsum(lead) - 1, [int(lead.sum())]))
    first = char_of[starts]
    last = char_of[ends - 1] + 1 if len(ends) else ends
    return starts.tolist(), ends.tolist(), first.tolist(), last.tolist()


def bpe_encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text",
               keep: tuple[str, ...] = (), offsets: bool = False,
               verify: bool = False) -> DataFrame:
    """``keep`` columns, ids array<int>, and with ``offsets`` the byte and
    character spans of the tokens.  ``verify`` decodes every text again and
    fails the job if it differs."""
    prepare(docs.sparkSession)
    base = docs.select(F.col(text_col).cast("string").alias("_text"), *keep)
    spans = ("byte_start", "byte_end", "char_start", "char_end")
    lists = StructType([StructField(c, ArrayType(IntegerType()))
                        for c in ("ids", *(spans if offsets else ()))])
    schema = StructType([*docs.select(*keep).schema.fields, *lists.fields])

    def run(batches):
        ints = pa.list_(pa.int32())
        for b in batches:
            texts = [t or "" for t in b.column(0).to_pylist()]
            ids = encode_texts(texts, path, pattern)
            if verify and any(decode_ids(i, path) != t.encode()
                              for i, t in zip(ids, texts, strict=True)):
                raise ValueError("decoded ids differ from their text")
            cols = [*b.columns[1:], pa.array(ids, ints)]
            if offsets:
                cols += [pa.array(c, ints) for c in zip(
                    *(token_offsets(i, t, path) for i, t in zip(ids, texts, strict=True)),
                    strict=True)] if ids else [pa.array([], ints)] * 4
            yield pa.RecordBatch.from_arrays(
                cols, names=[*keep, "ids", *(spans if offsets else ())])

    return base.mapInArrow(run, schema)


def bpe_decode(tokens: DataFrame, path: str, ids_col: str = "ids",
               keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns and data binary, the bytes the ids stand for; cast it
    to string for the text (ids of a whole text always form valid UTF-8)."""
    base = tokens.select(F.col(ids_col).alias("_ids"), *keep)

    def run(batches):
        for b in batches:
            data = [decode_ids(i or [], path) for i in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(data, pa.binary())],
                                             names=[*keep, "data"])

    return base.mapInArrow(run, StructType([
        *tokens.select(*keep).schema.fields, StructField("data", BinaryType())]))


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                     ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def bpe_digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode, decode, and digest both in one pass over the texts, without
    moving the ids through the JVM."""
    prepare(docs.sparkSession)

    def run(batches):
        sha = hashlib.sha256
        decimal = [str(i) for i in range(len(byte_table(path)))].__getitem__
        for b in batches:
            all_ids = encode_texts([t or "" for t in b.column(1).to_pylist()], path, pattern)
            yield batch(_DIGEST, b.column(0), [len(i) for i in all_ids],
                        [sha(" ".join(map(decimal, i)).encode()).hexdigest() for i in all_ids],
                        [sha(decode_ids(i, path)).hexdigest() for i in all_ids])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
