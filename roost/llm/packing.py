"""Best-fit packing of whole documents into sequences of a fixed number of tokens.

A document is the ids of a public tokenizer, then an end id. Longer ones are cut into
pieces of ``CAPACITY``; all but the last of them fill a sequence. Pieces are packed best
fit, longest first: a segment tree over remaining capacities knows which capacities have an
open sequence, and the least one that is large enough is found on one way down the tree.

Pieces are dealt by hash to shards of about ``SHARD`` pieces, each packed by one task.
With that many pieces a shard leaves at most its last sequences open, so the number of
shards, which grows with the input, costs next to nothing.

Tokens of a word do not depend on its neighbours, since the tokenizer drops white space,
so a task keeps the ids of words that it has met, up to ``CACHED``. A word of printable ASCII
and of Latin-1 letters is cut as the tokenizer cuts it, and only its parts are encoded: for
those the tokenizer's normal form is the lower-case word. All other words go through the
whole tokenizer.

Null text is empty: a document of the end id alone. Repeated rows are packed one by one,
each as a document of its own. Extra columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roost.llm.store import keep

CAPACITY = 2048
END_ID = 0
SHARD = 200_000
CACHED = 400_000
TOKENIZER = "word_bpe_49k.json"


#: Words whose normal form is plain lower case, and the tokenizer's pieces of that.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
#: Bytes of those letters in UTF-8, as the characters that stand for them in the vocabulary.
_BYTE_CHARS = {b: chr(256 + i) for i, b in enumerate([*range(33), *range(127, 161), 173])}


class WordIds(dict):
    """Ids of a word, as bytes of little-endian 32-bit numbers."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED:
            self.clear()
        # Special tokens are found before lower-casing, so their case counts.
        if len(word) <= 64 and _PLAIN.fullmatch(word) and "<|" not in word:
            lower = word.lower()
            if lower != word:
                ids = self[lower]
            else:
                pieces = _PIECES.findall(word)
                ids = self.piece(word) if len(pieces) == 1 else b"".join([self[p] for p in pieces])
        else:
            ids = self.encoded(word)
        if len(word) <= 64:
            self[word] = ids
        return ids

    def piece(self, piece: str) -> bytes:
        """Ids of one piece of the pre-tokenizer."""
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(_BYTE_CHARS)
        ids = [t.id for t in self.model.tokenize(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encoded(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()


#: What str.split() takes for white space, unlike the tokenizer, and the runs between the tokenizer's own.
_NOT_SPACE = "\x1c\x1d\x1e\x1f"
_RUNS = re.compile(rf"(?:\S|[{_NOT_SPACE}])+")


def split_words(text: str) -> list[str]:
    """Runs of a text between white space of the tokenizer."""
    if any(c in text for c in _NOT_SPACE):
        return _RUNS.findall(text)
    return text.split()


_WORDS: dict[str, WordIds] = {}


def _words(path: str) -> WordIds:
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


def _pieces(tokenizer: str, capacity: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _words(public_tokenizers.path(tokenizer))
        end = np.array([END_ID], "<u4").tobytes()
        step = 4 * capacity
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = b"".join([*map(words.__getitem__, split_words(text or "")), end])
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            frame = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield frame.astype({"doc_id": "Int64"})

    return run


class OpenSequences:
    """Open sequences by remaining capacity, under a segment tree."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def tightest(self, length: int) -> int | None:
        """The least capacity of at least ``length`` that is open."""
        tree, node = self.any, self.leaves + length
        if not tree[node]:
            # Up until a right neighbour has something, then down its left edge.
            while True:
                if node == 1:
                    return None
                if not node & 1 and tree[node + 1]:
                    node += 1
                    break
                node >>= 1
            while node < self.leaves:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        return node - self.leaves

    def put(self, capacity: int, sequence: int) -> None:
        self.open[capacity].append(sequence)
        node = self.leaves + capacity
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def take(self, capacity: int) -> int:
        sequence = self.open[capacity].pop()
        if not self.open[capacity]:
            node = self.leaves + capacity
            self.any[node] = 0
            node >>= 1
            while node and not (self.any[2 * node] or self.any[2 * node + 1]):
                self.any[node] = 0
                node >>= 1
        return sequence


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; lengths in falling order."""
    sequences, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    bins, made = OpenSequences(capacity), 0
    for i, length in enumerate(lengths.tolist()):
        room = bins.tightest(length)
        if room is None:
            room, sequence, made = capacity, made, made + 1
        else:
            sequence = bins.take(room)
        sequences[i], offsets[i] = sequence, capacity - room
        if room > length:
            bins.put(room - length, sequence)
    return sequences, offsets


def _pack_shard(capacity: int):
    def run(key: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(
            ["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable"
        )
        sequences, offsets = best_fit(pieces["length"].to_numpy(), capacity)
        pieces["sequence_id"] = (int(key[0]) << 32) + sequences
        pieces["offset"] = offsets
        return pieces.drop(columns="shard")

    return run


def pack_documents(
    docs: DataFrame, *, capacity: int = CAPACITY, shard: int = SHARD, tokenizer: str = TOKENIZER
) -> DataFrame:
    """A row for each piece of each document, with its place."""
    columns = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    pieces = keep(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInPandas(
            _pieces(tokenizer, capacity), columns
        ),
        "pieces",
    )
    # A full piece is a sequence of its own: only the others need a place.
    shards = max(1, -(-pieces.filter(F.col("length") < capacity).count() // shard))
    full = pieces.filter(F.col("length") == capacity).select(
        "*",
        # negative numbers, apart from those of the shards
        (-F.monotonically_increasing_id() - 1).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    rest = pieces.filter(F.col("length") < capacity).withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards))
    )
    packed = rest.groupBy("shard").applyInPandas(
        _pack_shard(capacity), f"{columns}, sequence_id bigint, offset bigint"
    )
    return packed.unionByName(full)
