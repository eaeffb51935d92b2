"""Document fingerprints: Merkle trees over sections, paragraphs and passages.

A paragraph is a line with its line feed; a section ends after a blank line and after a
paragraph whose digest is 0 modulo 8; a passage, the leaf, ends with the paragraph and
after a word whose hash is 0 modulo 8. All borders depend on the content alone, so an edit
changes the leaves it touches and the nodes above them, nothing else. Leaves cover every
byte. The fingerprint is the root, 128 bits of SHA-256 over the sections' digests, which
are over the paragraphs', which are over the text itself: equal roots mean equal texts. It
ends with the passages, as 32 bits each, in the tree's shape: they say how alike two texts
are, and going down differing branches only locates an edit. The likeness of two fingerprints is the share of leaves in common, as
2 * common / (leaves of both), repeated leaves counted.

The next document, in the order of ids, is found on ids alone: they are range-sorted, and
of each range only the first id meets the others. Texts are shuffled once; what moves
between documents is the start of a text and its leaves.

Null text is empty; two empty texts have likeness 1. Rows without an id have no next
document: it counts as empty. Where an id repeats, each row is followed by the next greater
id, of whose rows one is taken, the same in every run.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roost.llm import words as W
from roost.llm.store import keep

_COLUMNS = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _node_hashes(children: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each run of children that begins at ``starts``."""
    counts = np.diff(np.append(starts, len(children)))
    at = np.arange(len(children)) - np.repeat(starts, counts)
    placed = W.mix(children.astype(np.uint64) + W.mix(at.astype(np.uint64) + np.uint64(1)))
    return W.mix(np.add.reduceat(placed, starts) + counts.astype(np.uint64))


def _digest(kind: bytes, data: bytes) -> bytes:
    """Nodes of different kinds never have equal input."""
    return hashlib.sha256(kind + b"\0" + data).digest()


class Tree:
    """``leaves`` (32-bit), where paragraphs start among them, and sections among those."""

    def __init__(self, text: str | None):
        data = (text or "").encode("utf-8", "surrogatepass")
        raw = np.frombuffer(data, np.uint8)
        n = len(raw)
        if not n:
            self.leaves = np.empty(0, np.uint32)
            self.paragraphs = self.sections = np.empty(0, np.int64)
            self.digests = []
            return
        up, down = W._powers(n)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(W._BYTES[raw] * up)))
        inside = np.concatenate(([False], ~W._IS_GAP[raw], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = edges[0::2], edges[1::2]
        hashes = W.mix((sums[last] - sums[first]) * down[first])
        # A passage begins with the word after one that ends it, and with each paragraph.
        ends = np.flatnonzero(hashes[:-1] % np.uint64(8) == 0)
        breaks = np.flatnonzero(raw == 10) + 1
        lines = np.concatenate(([0], breaks[breaks < n]))
        starts = np.union1d(lines, first[ends + 1])
        stops = np.append(starts[1:], n)
        lengths = (stops - starts).astype(np.uint64)
        spans = (sums[stops] - sums[starts]) * down[starts]
        self.leaves = (W.mix(spans + W.mix(lengths)) >> np.uint64(32)).astype(np.uint32)
        self.paragraphs = np.searchsorted(starts, lines)
        digests = _node_hashes(self.leaves, self.paragraphs)
        blank = np.diff(np.append(lines, n)) == 1
        closing = blank | (digests % np.uint64(8) == 0)
        self.sections = np.concatenate(([0], np.flatnonzero(closing[:-1]) + 1))
        bounds = [*lines.tolist(), n]
        self.digests = [_digest(b"paragraph", data[a:b]) for a, b in zip(bounds, bounds[1:])]

    def root(self) -> str:
        """Half a SHA-256 over the sections' digests, theirs over the paragraphs', theirs over the bytes."""
        bounds = [*self.sections.tolist(), len(self.digests)]
        sections = [_digest(b"section", b"".join(self.digests[a:b])) for a, b in zip(bounds, bounds[1:])]
        return _digest(b"text", b"".join(sections)).hex()[:32]

    def fingerprint(self) -> str:
        """root:leaves, paragraphs apart by commas and sections by slashes."""
        digits = self.leaves.astype(">u4").tobytes().hex()
        cuts = [*(8 * self.paragraphs).tolist(), len(digits)]
        lines = [digits[a:b] for a, b in zip(cuts, cuts[1:])]
        cuts = [*self.sections.tolist(), len(lines)]
        return self.root() + ":" + "/".join(",".join(lines[a:b]) for a, b in zip(cuts, cuts[1:]))


def leaves_of(fingerprint: str) -> np.ndarray:
    digits = fingerprint.partition(":")[2].replace("/", "").replace(",", "")
    return np.frombuffer(bytes.fromhex(digits), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the leaves that two trees have in common."""
    if not len(a) and not len(b):
        return 1.0
    one, many = np.unique(a, return_counts=True)
    two, more = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(one, two, assume_unique=True, return_indices=True)
    return float(2 * np.minimum(many[i], more[j]).sum() / (len(a) + len(b)))


def edited_places(old: str, new: str) -> list[tuple[int, int]]:
    """(section, paragraph) of ``new`` that ``old`` lacks; equal branches are not opened."""
    if old.partition(":")[0] == new.partition(":")[0]:
        return []
    sections = set(old.partition(":")[2].split("/"))
    lines = {line for section in sections for line in section.split(",")}
    return [
        (i, k)
        for i, section in enumerate(new.partition(":")[2].split("/"))
        if section not in sections
        for k, line in enumerate(section.split(","))
        if line not in lines
    ]


def _sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What a document needs of the next: the start of its text, compressed, and its leaves."""
    for batch in batches:
        heads = [(t or "")[:n] for t, n in zip(batch["text"], batch["take"])]
        yield pd.DataFrame(
            {
                "to_id": batch["to_id"],
                "head": [zlib.compress(head.encode("utf-8", "surrogatepass")) for head in heads],
                "next_leaves": [Tree(t).leaves.astype("<u4").tobytes() for t in batch["text"]],
            }
        )


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, text, head, leaves in zip(
            batch["doc_id"], batch["text"], batch["head"], batch["next_leaves"]
        ):
            text = text or ""
            head = zlib.decompress(head).decode("utf-8", "surrogatepass") if head else ""
            n = len(text)
            edited = text[: n - n // 4] + head[: n // 4]
            own, other = Tree(text), Tree(edited)
            following = np.frombuffer(leaves or b"", "<u4").astype(np.uint32)
            rows.append(
                (
                    doc_id,
                    n,
                    hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                    own.fingerprint(),
                    other.fingerprint(),
                    likeness(own.leaves, other.leaves),
                    likeness(own.leaves, following),
                )
            )
        names = [c.split()[0] for c in _COLUMNS.split(", ")]
        yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})


def _next_ids(ids: DataFrame) -> DataFrame:
    """Add ``next_id`` to distinct ids; after the last comes the first."""
    ordered = keep(ids.orderBy("doc_id").withColumn("part", F.spark_partition_id()), "ids")
    parts = ordered.groupBy("part").agg(F.min("doc_id").alias("least"))
    order = Window.orderBy("part")
    parts = parts.select(
        "part",
        F.coalesce(
            F.lead("least").over(order),
            F.min("least").over(Window.partitionBy(F.lit(0))),
        ).alias("following"),
    )
    inside = F.lead("doc_id").over(Window.partitionBy("part").orderBy("doc_id"))
    return (
        ordered.withColumn("inside", inside)
        .join(parts, "part")
        .withColumn("next_id", F.coalesce("inside", "following"))
        .drop("part", "inside", "following")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how near they are."""
    # No alias where none is needed: both joins then find the same shuffle of the texts.
    if docs.schema["doc_id"].dataType.simpleString() != "bigint":
        docs = docs.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    docs = docs.select("doc_id", "text")
    known = docs.filter("doc_id is not null")
    sizes = known.groupBy("doc_id").agg(F.max(F.coalesce(F.length("text"), F.lit(0))).alias("n"))
    asked = _next_ids(sizes).select(
        F.col("next_id").alias("doc_id"),
        F.col("doc_id").alias("to_id"),
        F.floor(F.col("n") / 4).cast("int").alias("take"),
    )
    sent = (
        known.join(asked, "doc_id")
        .mapInPandas(_sent, "to_id bigint, head binary, next_leaves binary")
        .groupBy("to_id")
        .agg(F.min(F.struct("head", "next_leaves")).alias("least"))
        .select(F.col("to_id").alias("doc_id"), "least.*")
    )
    followed = known.join(sent, "doc_id", "left").select("doc_id", "text", "head", "next_leaves")
    alone = docs.filter("doc_id is null").select(
        "doc_id", "text", F.lit(b"").alias("head"), F.lit(b"").alias("next_leaves")
    )
    return followed.unionByName(alone).mapInPandas(_compared, _COLUMNS)
