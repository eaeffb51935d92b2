"""Alignment of two tokenizers over the same bytes, and how good each link is corpus-wide.

Each text is encoded by A (byte-level BPE, after a space that is put in front) and by B
(pieces, which puts that space in front itself), as whole. Byte offsets where tokens of both
end cut them into groups. The groups are found by pointer jumping: each token points to the
farthest-right token that overlaps it, and doubling the pointers of a whole batch of texts
at once leads every token to the last token of A in its group. All tokens of A and of B in
a group are linked.

The count of an id pair is the number of documents that hold it linked. Documents are
handled in chunks of at most about ``CHUNK`` different pairs per document, added up. A chunk
knows its own pairs by number, a document keeps (pair number, times) in a packed column, and
what is shuffled per pair is one row for each chunk that has it: to add up its documents, and
to bring the sum and the mark of a best link back to the chunk. No pair of a single document
is shuffled, no table of pairs is broadcast.

Null and empty texts have no tokens, nor have texts whose tokens' bytes do not give the text
back (a U+2581, or text that is not valid UTF-8): all numbers are 0 and the digest is ''.
Every row is a document, repeated rows and rows without an id too; extra columns are ignored.
An empty table gives no rows. Links within a long group are counted by distinct ids and
their times, so a group of many equal tokens costs no more than its length.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roost.llm.store import keep

# The same ids as byte_bpe_50k.json gives, several times as fast; a test compares them.
BYTE_LEVEL = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
CHUNK = 3_000_000
SLICE = 1 << 16
_CHARS = 1_000_000  # of texts that are aligned at once
_EXPANDED = 2_000_000
_A = 16  # bits below the A id in a pair

_LOADED: dict[tuple[str, str], _Encoders] = {}


class _Encoders:
    """Both tokenizers with the bytes of each id, and ids as text behind each separator."""

    def __init__(self, byte_level: str, pieces: str):
        with open(byte_level, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.a = tiktoken.Encoding(
            byte_level, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.a_bytes[rank] = token
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_sizes = np.array([len(x) for x in self.a_bytes])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        most = max(len(self.a_bytes), len(self.b_bytes))
        self.texts = [mark + str(i) for i in range(most) for mark in ("", ",", ";", "|")]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode("utf-8")

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both, none where they do not spell the text."""
        out = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1)):
            a = self.a.encode_ordinary(" " + text) if text else []
            whole = b" " + text.encode("utf-8") if text else b""
            same = b"".join(map(self.a_bytes.__getitem__, a)) == whole
            same = same and b"".join(map(self.b_bytes.__getitem__, b)) == whole
            out.append((a, b) if same else ([], []))
        return out


def _encoders(byte_level: str, pieces: str) -> _Encoders:
    if (byte_level, pieces) not in _LOADED:
        _LOADED[byte_level, pieces] = _Encoders(
            public_tokenizers.path(byte_level), public_tokenizers.path(pieces)
        )
    return _LOADED[byte_level, pieces]


def groups_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B, from the bytes where they end."""
    n = len(a_ends)
    over_a = np.searchsorted(b_ends, a_ends)
    over_b = np.searchsorted(a_ends, b_ends)
    last = b_ends[over_a] == a_ends if n else np.empty(0, bool)
    successor = np.concatenate((np.where(last, np.arange(n), n + over_a), over_b))
    while True:
        doubled = successor[successor]
        if np.array_equal(doubled, successor):
            break
        successor = doubled
    number = np.cumsum(last) - 1
    group = number[successor]
    return group[:n], group[n:]


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their times added up."""
    if not len(keys):
        return keys, times
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(times[order], first)


class Aligned:
    """A batch of encoded texts: groups of all of them, numbered through."""

    def __init__(self, encoded: list[tuple[list[int], list[int]]], encoders: _Encoders):
        self.n_a = np.array([len(a) for a, _ in encoded], np.int64)
        self.n_b = np.array([len(b) for _, b in encoded], np.int64)
        self.a = np.array([i for a, _ in encoded for i in a], np.int64)
        self.b = np.array([i for _, b in encoded for i in b], np.int64)
        self.a_ends = np.cumsum(encoders.a_sizes[self.a])
        self.b_ends = np.cumsum(encoders.b_sizes[self.b])
        self.of_a, self.of_b = groups_of(self.a_ends, self.b_ends)
        doc_of_a = np.repeat(np.arange(len(encoded)), self.n_a)
        n = int(self.of_a[-1]) + 1 if len(self.of_a) else 0
        self.a_sizes = np.bincount(self.of_a, minlength=n)
        self.b_sizes = np.bincount(self.of_b, minlength=n)
        self.doc = np.zeros(n, np.int64)
        self.doc[self.of_a] = doc_of_a
        self.n_groups = np.bincount(self.doc, minlength=len(encoded))
        links = np.concatenate(([0], np.cumsum(self.a_sizes * self.b_sizes)))
        ends = np.cumsum(self.n_groups)
        self.n_links = links[ends] - links[ends - self.n_groups]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """doc, id pair and times linked, each pair once for each document, in order."""
        a_keys, a_times = _summed(self.of_a << 16 | self.a, np.ones(len(self.a), np.int64))
        b_keys, b_times = _summed(self.of_b << 16 | self.b, np.ones(len(self.b), np.int64))
        group = a_keys >> 16
        b_first = np.searchsorted(b_keys >> 16, np.arange(len(self.a_sizes) + 1))
        wide = np.diff(b_first)[group]
        ends = np.cumsum(wide)
        keys, times, at = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0
        while at < len(group):
            done = ends[at] - wide[at]
            to = max(at + 1, int(np.searchsorted(ends, done + _EXPANDED, "right")))
            rows = np.repeat(np.arange(at, to), wide[at:to])
            begins = (ends - wide)[at:to] - done
            b = np.arange(len(rows)) - np.repeat(begins, wide[at:to]) + b_first[group[rows]]
            key = self.doc[group[rows]] << 32 | (a_keys[rows] & 0xFFFF) << _A | b_keys[b] & 0xFFFF
            key, n = _summed(key, a_times[rows] * b_times[b])
            keys.append(key)
            times.append(n)
            at = to
        key, n = _summed(np.concatenate(keys), np.concatenate(times))
        return key >> 32, key & 0xFFFFFFFF, n

    def digests(self, texts: list[str]) -> list[str]:
        """SHA-256 of the groups of each document as text, '' without tokens."""
        a_before = np.concatenate(([0], np.cumsum(self.a_sizes)))
        b_before = np.concatenate(([0], np.cumsum(self.b_sizes)))
        first_of_doc = np.concatenate(([True], self.doc[1:] != self.doc[:-1])) if len(self.doc) else []
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        a_mark = np.ones(len(self.a), np.int64)
        a_mark[a_before[:-1]] = np.where(first_of_doc, 0, 2)
        codes[np.arange(len(self.a)) + b_before[self.of_a]] = self.a * 4 + a_mark
        b_mark = np.ones(len(self.b), np.int64)
        b_mark[b_before[:-1]] = 3
        codes[np.arange(len(self.b)) + a_before[self.of_b + 1]] = self.b * 4 + b_mark
        parts = list(map(texts.__getitem__, codes.tolist()))
        out, at = [], 0
        for n in (self.n_a + self.n_b).tolist():
            whole = "".join(parts[at : at + n])
            out.append(hashlib.sha256(whole.encode()).hexdigest() if n else "")
            at += n
        return out


def _batched(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts, about ``_CHARS`` characters at a time."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            ids.append(doc_id)
            texts.append(text or "")
            held += len(texts[-1]) + 20
            if held > _CHARS:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def packed(pairs: np.ndarray, times: np.ndarray) -> bytes:
    """Rising pair numbers as steps; times only where they are not 1."""
    more = np.flatnonzero(times != 1)
    raw = (
        np.array([len(pairs), len(more)], "<u4").tobytes()
        + np.diff(pairs, prepend=0).astype("<u4").tobytes()
        + more.astype("<u4").tobytes()
        + times[more].astype("<i8").tobytes()
    )
    return zlib.compress(raw, 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(data)
    n, more = np.frombuffer(raw, "<u4", 2).tolist()
    pairs = np.cumsum(np.frombuffer(raw, "<u4", n, 8), dtype=np.int64)
    times = np.ones(n, np.int64)
    times[np.frombuffer(raw, "<u4", more, 8 + 4 * n)] = np.frombuffer(raw, "<i8", more, 8 + 4 * (n + more))
    return pairs, times


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_CHUNK_ROWS = (
    "chunk bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, linked binary, first int, pairs array<bigint>, holders array<int>"
)


def _chunked(byte_level: str, pieces: str):
    """A row for each document, and rows with the pairs of each chunk, ``SLICE`` at most in one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoders = _encoders(byte_level, pieces)
        chunk = TaskContext.get().partitionId() << 32
        docs: list[dict] = []
        linked: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def flush() -> Iterator[pd.DataFrame]:
            nonlocal chunk, held
            if not docs:
                return
            together = np.concatenate([pairs for pairs, _ in linked])
            known, holders = np.unique(together, return_counts=True)
            at = np.searchsorted(known, together)
            ends = np.cumsum([len(pairs) for pairs, _ in linked])
            for doc, (_, times), end in zip(docs, linked, ends.tolist()):
                doc["linked"] = packed(at[end - len(times) : end], times)
                doc["chunk"] = chunk
            yield _frame(docs)
            slices = [
                {
                    "chunk": chunk,
                    "first": k,
                    "pairs": known[k : k + SLICE].tolist(),
                    "holders": holders[k : k + SLICE].tolist(),
                }
                for k in range(0, len(known), SLICE)
            ]
            if slices:
                yield _frame(slices)
            docs.clear()
            linked.clear()
            chunk, held = chunk + 1, 0

        for ids, texts in _batched(batches):
            batch = Aligned(encoders.encode(texts), encoders)
            doc, pair, times = batch.pairs()
            cuts = np.searchsorted(doc, np.arange(len(ids) + 1)).tolist()
            digests = batch.digests(encoders.texts)
            for k, doc_id in enumerate(ids):
                docs.append(
                    {
                        "doc_id": doc_id,
                        **{name: int(getattr(batch, name)[k]) for name in _COUNTS},
                        "groups_sha256": digests[k],
                    }
                )
                linked.append((pair[cuts[k] : cuts[k + 1]], times[cuts[k] : cuts[k + 1]]))
            held += len(pair)
            if held > CHUNK:
                yield from flush()
        yield from flush()

    return run


def _frame(rows: list[dict]) -> pd.DataFrame:
    frame = pd.DataFrame(rows)
    for name in _CHUNK_ROWS.split(", "):
        column, kind = name.split()
        if column not in frame:
            frame[column] = None
        if kind in ("bigint", "int"):
            frame[column] = frame[column].astype("Int64" if kind == "bigint" else "Int32")
    return frame[[name.split()[0] for name in _CHUNK_ROWS.split(", ")]]


def _rated(docs: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """Counts of a chunk's pairs, applied to its documents."""
    holders = np.zeros(int(pairs["number"].max()) + 1 if len(pairs) else 0, np.int64)
    best = np.zeros(len(holders), np.int64)
    holders[pairs["number"]] = pairs["holders"]
    best[pairs["number"]] = pairs["best"]
    n_best, sums = [], []
    for data in docs["linked"]:
        number, times = unpacked(data)
        n_best.append(int((best[number] * times).sum()))
        sums.append(int((holders[number] * times).sum()))
    out = docs[["doc_id", *_COUNTS]].copy()
    out["n_best"], out["count_sum"], out["groups_sha256"] = n_best, sums, docs["groups_sha256"]
    return out.astype({"doc_id": "Int64"})


def _chunks(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return keep(rows.mapInPandas(_chunked(byte_level, pieces), _CHUNK_ROWS), "alignment")


def _pairs(chunks: DataFrame) -> DataFrame:
    """chunk, number of the pair in it, pair, documents of the chunk that hold it."""
    zipped = F.posexplode(F.arrays_zip("pairs", "holders")).alias("at", "each")
    return (
        chunks.filter("pairs is not null")
        .select("chunk", "first", zipped)
        .select("chunk", (F.col("first") + F.col("at")).alias("number"), "each.pairs", "each.holders")
        .withColumnRenamed("pairs", "pair")
    )


def _totals(pairs: DataFrame) -> DataFrame:
    """pair, holders over all chunks, best (1 if no pair of its A id has more)."""
    totals = pairs.groupBy("pair").agg(F.sum("holders").alias("holders"))
    totals = totals.withColumn("a", F.shiftright("pair", _A))
    most = totals.groupBy("a").agg(F.max("holders").alias("most"))
    return totals.join(most, "a").select(
        "pair", "holders", (F.col("holders") == F.col("most")).cast("int").alias("best")
    )


def dictionary(docs: DataFrame, *, byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> DataFrame:
    """a_id, b_id, holders (documents that link them), best: a dictionary from A to B."""
    totals = _totals(_pairs(_chunks(docs, byte_level, pieces)))
    low = F.col("pair").bitwiseAND(F.lit((1 << _A) - 1))
    return totals.select(
        F.shiftright("pair", _A).cast("int").alias("a_id"),
        low.cast("int").alias("b_id"),
        "holders",
        (F.col("best") == 1).alias("best"),
    )


def _grouped(byte_level: str, pieces: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoders = _encoders(byte_level, pieces)
        for ids, texts in _batched(batches):
            batch = Aligned(encoders.encode(texts), encoders)
            a_ends, b_ends = np.cumsum(batch.a_sizes), np.cumsum(batch.b_sizes)
            ends = batch.a_ends[a_ends - 1] if len(a_ends) else a_ends
            starts = np.concatenate(([0], ends))[:-1]
            firsts = np.concatenate(([0], np.cumsum(batch.n_groups)))
            yield pd.DataFrame(
                {
                    "doc_id": pd.Series([ids[d] for d in batch.doc.tolist()], dtype="Int64"),
                    "group": np.arange(len(ends)) - firsts[batch.doc],
                    "start": starts - starts[firsts[batch.doc]] if len(ends) else starts,
                    "length": ends - starts,
                    "a_ids": [batch.a[e - n : e].tolist() for e, n in zip(a_ends, batch.a_sizes)],
                    "b_ids": [batch.b[e - n : e].tolist() for e, n in zip(b_ends, batch.b_sizes)],
                }
            )

    return run


def token_groups(docs: DataFrame, *, byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> DataFrame:
    """Each group with its ids; start and length in bytes of a space and the text."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = "doc_id bigint, group int, start bigint, length bigint, a_ids array<int>, b_ids array<int>"
    return rows.mapInPandas(_grouped(byte_level, pieces), schema)


def alignment(docs: DataFrame, *, byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> DataFrame:
    """Tokens, groups and links of each document, and how its links rate corpus-wide."""
    chunks = _chunks(docs, byte_level, pieces)
    pairs = _pairs(chunks)
    rated = pairs.select("chunk", "number", "pair").join(_totals(pairs), "pair").drop("pair")
    of_chunk = F.col("chunk").alias("of_chunk")  # the other side of the cogroup has a chunk too
    rows = chunks.filter("pairs is null").select(of_chunk, "doc_id", *_COUNTS, "groups_sha256", "linked")
    return (
        rows.groupBy("of_chunk")
        .cogroup(rated.groupBy("chunk"))
        .applyInPandas(
            _rated,
            "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
            "n_best bigint, count_sum bigint, groups_sha256 string",
        )
    )
