"""Token counts of sections, from one encoding of each whole document.

Encoding sections apart gives other tokens at their borders, and encoding both costs twice.
Here a document is encoded once; the spans of its tokens, in bytes, are joined to the
sections' intervals, both in order. A token that crosses a border counts for the section
that holds its middle byte, of two middle ones the earlier. So counts of sections add up to
the document's.

Sections are the document's lines, each with its line feed. Null text is empty; an empty
text is one section of no token. Repeated rows are counted one by one; extra columns are
ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "byte_bpe_50k.tiktoken"

_LOADED: dict[str, tuple[tiktoken.Encoding, np.ndarray]] = {}


def _encoding(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding, and the bytes that each id stands for."""
    if path not in _LOADED:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            sizes[rank] = len(token)
        encoding = tiktoken.Encoding(
            path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        _LOADED[path] = encoding, sizes
    return _LOADED[path]


def attribute(sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Tokens of each section: byte lengths of the tokens, first bytes of the sections."""
    ends = np.cumsum(sizes)
    middles = ends - sizes + (sizes - 1) // 2
    return np.bincount(np.searchsorted(starts, middles, "right") - 1, minlength=len(starts))


def _counted(tokenizer: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding, sizes = _encoding(public_tokenizers.path(tokenizer))
        for batch in batches:
            parts = {name: [] for name in ("doc_id", "section", "start", "length", "n_tokens")}
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                # Halves of surrogate pairs have no bytes of their own.
                text = (text or "").encode("utf-8", "replace").decode("utf-8")
                raw = np.frombuffer(text.encode("utf-8"), np.uint8)
                breaks = np.flatnonzero(raw == 10) + 1
                starts = np.concatenate(([0], breaks[breaks < len(raw)]))
                tokens = np.array(encoding.encode_ordinary(text), np.int64)
                counts = attribute(sizes[tokens], starts) if len(tokens) else np.zeros(1, np.int64)
                chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
                first = chars[starts]
                parts["doc_id"].append(pd.Series([doc_id] * len(starts), dtype="Int64"))
                parts["section"].append(np.arange(len(starts)))
                parts["start"].append(first)
                parts["length"].append(np.append(first[1:], len(text)) - first)
                parts["n_tokens"].append(counts)
            if parts["doc_id"]:
                frame = {k: np.concatenate(v) for k, v in parts.items() if k != "doc_id"}
                yield pd.DataFrame({"doc_id": pd.concat(parts["doc_id"], ignore_index=True), **frame})

    return run


def section_tokens(docs: DataFrame, *, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, section (from 0), start and length in code points, n_tokens."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInPandas(
        _counted(tokenizer), "doc_id bigint, section int, start bigint, length bigint, n_tokens bigint"
    )
