"""Byte-level BPE: encoding with the tokenizers library over Arrow batches, and decoding by the byte table.

The vocabulary is a file of ranks (base64 token, rank) named by the caller; nothing is
trained. A text is first split by the vocabulary's pattern. The distinct pieces of a
batch go through the library's model once, and texts are put together from the pieces'
ids, so a frequent word is merged once per task and not once per occurrence.

A rank file allows every pair of tokens whose concatenation is a token, so the model
gets all such pairs as merges, in the order of the merged token's rank.

Cases: a null or empty text has no ids and decodes to no bytes; text of any length is
encoded whole; repeated rows are encoded alike; an empty table gives an empty table;
only the named columns are read, so further columns never clash.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces, released

#: Entries of a worker's memory of pieces, after which it starts anew, and the longest piece that it keeps.
MEMORY, LONGEST = 400_000, 64
#: Text bytes encoded at a time: their pieces are Python objects, some ten times as large.
BATCH_BYTES = 1 << 20


def byte_table() -> list[str]:
    """The printable character that stands for each byte: visible Latin-1 bytes for themselves, the rest from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    table, rest = [], 256
    for b in range(256):
        table.append(chr(b if b in own else rest))
        rest += b not in own
    return table


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def shown_tokens(path: str) -> dict[str, int]:
    """The vocabulary with a printable character for each byte."""
    table = byte_table()
    return {"".join(table[b] for b in token): rank for token, rank in read_ranks(path).items()}


@lru_cache(maxsize=2)
def _model(path: str):
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocab = shown_tokens(path)
    merges = [
        (token[:i], token[i:])
        for token in sorted(vocab, key=vocab.get)
        for i in range(1, len(token))
        if token[:i] in vocab and token[i:] in vocab
    ]
    model = Tokenizer(models.BPE(vocab=vocab, merges=merges))
    model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return model


class Encoder:
    """Ids of texts; remembers the pieces that it has seen as packed 32-bit ids."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.model, self.split, self.seen = _model(path), regex.compile(pattern).findall, {}

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.split(t) for t in texts]
        if len(self.seen) > MEMORY:
            self.seen = {}
        new = list(set(chain.from_iterable(split)).difference(self.seen))
        if new:
            found = self.model.encode_batch_fast(new, add_special_tokens=False)
            self.seen.update((p, array("i", e.ids).tobytes()) for p, e in zip(new, found, strict=True))
        packed = [b"".join(map(self.seen.__getitem__, parts)) for parts in split]
        # Long pieces are known for this call only; the memory is never copied for them.
        for p in new:
            if len(p) > LONGEST:
                del self.seen[p]
        return packed


@lru_cache(maxsize=1)
def _encoder(path: str, pattern: str) -> Encoder:
    """A worker's encoder: its memory of pieces outlives a task."""
    return Encoder(path, pattern)


def char_offsets(text: str, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end character of each token, given the tokens' lengths in bytes.

    A token that holds a part of a character only is given the whole character.
    """
    raw = np.frombuffer(text.encode(), np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    ends = np.cumsum(lengths)
    if not len(ends):
        return ends, ends
    return char[ends - lengths], char[ends - 1] + 1


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None, offsets: bool = False) -> DataFrame:
    """The columns `keep` with ids array<int>; with offsets also starts and ends, in characters, end exclusive."""
    keep = keep or []
    chosen = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = T.StructType([f for f in chosen.schema if f.name != "_text"])
    for name in ("ids", "starts", "ends") if offsets else ("ids",):
        schema.add(name, T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _encoder(path, pattern)
        widths = np.array([len(b) for b in token_bytes(path)]) if offsets else None
        for batch in pieces(batches, "_text", BATCH_BYTES):
            texts = batch.column("_text").to_pylist()
            packed = encoder.encode(texts)
            edges = pa.array(np.cumsum([0, *map(len, packed)]) // 4, pa.int32())
            out = [pa.ListArray.from_arrays(edges, pa.array(np.frombuffer(b"".join(packed), np.int32)))]
            if offsets:
                both = [char_offsets(t, widths[np.frombuffer(b, np.int32)]) for t, b in zip(texts, packed, strict=True)]
                for side in (0, 1):
                    values = np.concatenate([np.zeros(0, np.int64), *(x[side] for x in both)]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(edges, pa.array(values)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *out], names=schema.names)

    return chosen.mapInArrow(released(run), schema)


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """Bytes of each id, from the vocabulary's printable tokens by the reversed byte table; unused ids have none."""
    back = {shown: b for b, shown in enumerate(byte_table())}
    vocab = shown_tokens(path)
    table = [b""] * (max(vocab.values()) + 1)
    for shown, i in vocab.items():
        table[i] = bytes(back[c] for c in shown)
    return table


def decode(df: DataFrame, path: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` with decoded binary.

    Bytes are joined before they are read as characters, so a character split over several ids
    comes back whole. Null ids give no bytes.
    """
    keep = keep or []
    chosen = df.select(*keep, F.col(ids).cast("array<int>").alias("_ids"))
    schema = T.StructType([f for f in chosen.schema if f.name != "_ids"]).add("decoded", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                lists = part.column("_ids")
                out = [b"".join(map(table.__getitem__, x.values.to_pylist())) if x.is_valid else b"" for x in lists]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(out, pa.binary())], names=schema.names)

    return chosen.mapInArrow(released(run), schema)


def decode_text(decoded: str) -> Column:
    """Decoded bytes as text; a character that the ids cut off at either end becomes the replacement character."""
    return F.make_valid_utf8(F.col(decoded).cast("string"))
