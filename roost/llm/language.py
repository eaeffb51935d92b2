"""Language identification: the family first, then one-versus-one inside it.

Features are the relative frequencies of hashed pairs and triples of bytes of a text in
lower case, everything but letters read as a blank. Languages whose mean vectors lie close
are joined into about the square root of their number of families. Linear support vector
machines tell families apart, one against one, and then the languages of the chosen family.
Each votes; equal votes are settled by the sum of margins, then by name.

Training reads at most ``PER_LANGUAGE`` labelled texts of each language, those of the least
id hashes, as vectors of ``BUCKETS`` numbers. Every text is scored as a whole; as the
machines are linear, its score is a mean of weights.

The score is the product of the logistic values of the least margins on the way.
A text that is null or has no letter is ``und`` with score 0; so is every text if nothing
was learned. Rows without an id are scored but never learned from, and not held out. With one language learned, that is the answer, with score 1. Empty and very long
texts, ties and repeated rows need no special care; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roost.llm.store import keep
from roost.llm.svm import fit_svm, sigmoid

PER_LANGUAGE = 300
BUCKETS = 8192
_SENT = 300_000  # chosen rows that may be broadcast
_SCALE = 30.0
_PENALTY = 0.1
_LETTER = regex.compile(r"\p{L}")
_PLAIN = np.full(256, 32, np.uint8)
_PLAIN[97:123] = np.arange(97, 123)
_PLAIN[65:91] = np.arange(97, 123)
_PLAIN[128:] = np.arange(128, 256)


def _grams(text: str) -> np.ndarray:
    """Buckets of all pairs and triples of bytes."""
    if not text.isascii():
        text = text.lower()
    raw = _PLAIN[np.frombuffer(f" {text} ".encode("utf-8", "surrogatepass"), np.uint8)]
    kept = raw[np.concatenate(([True], (raw[1:] != 32) | (raw[:-1] != 32)))].astype(np.uint32)
    pairs = kept[:-1] * np.uint32(256) + kept[1:]
    triples = pairs[:-1] * np.uint32(256) + kept[2:]
    half = np.uint32(BUCKETS // 2)
    fold = lambda x: (x * np.uint32(2654435761) >> np.uint32(15)) % half
    return np.concatenate((fold(pairs), fold(triples + np.uint32(1 << 24)) + half))


def _vector(text: str) -> np.ndarray:
    grams = _grams(text)
    return (np.bincount(grams, minlength=BUCKETS) * (_SCALE / len(grams))).astype(np.float32)


def _vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [(lang, _vector(t).tobytes()) for lang, t in zip(batch["lang"], batch["text"]) if _LETTER.search(t)]
        yield pd.DataFrame(found, columns=["lang", "vector"])


class Machines:
    """One-versus-one machines between named classes."""

    def __init__(self, vectors: dict[str, np.ndarray]):
        self.names = sorted(vectors)
        self.pairs = list(combinations(range(len(self.names)), 2))
        weights = []
        for a, b in self.pairs:
            x = np.vstack([vectors[self.names[a]], vectors[self.names[b]]])
            many, more = len(vectors[self.names[a]]), len(vectors[self.names[b]])
            y = np.repeat([1.0, -1.0], [many, more])
            balance = np.repeat([0.5 * len(x) / many, 0.5 * len(x) / more], [many, more])
            weights.append(fit_svm(x, y, _PENALTY, balance))
        table = np.array(weights).reshape(len(self.pairs), BUCKETS + 1)
        self.weights = table[:, :-1].T.astype(np.float32).copy() * np.float32(_SCALE)
        self.bias = table[:, -1]

    def choose(self, grams: np.ndarray) -> tuple[str, float]:
        if not self.pairs:
            return self.names[0], 1.0
        margins = self.weights[grams].mean(axis=0, dtype=np.float64) + self.bias
        votes, sums = np.zeros(len(self.names)), np.zeros(len(self.names))
        for (a, b), margin in zip(self.pairs, margins):
            votes[a if margin >= 0 else b] += 1
            sums[a] += margin
            sums[b] -= margin
        best = max(range(len(self.names)), key=lambda i: (votes[i], sums[i], -i))
        own = [m if a == best else -m for (a, b), m in zip(self.pairs, margins) if best in (a, b)]
        return self.names[best], float(sigmoid(2 * min(own)))


class LanguageModel:
    def __init__(self, vectors: dict[str, np.ndarray]):
        self.families = families(vectors)
        self.top = Machines({f[0]: np.vstack([vectors[x] for x in f]) for f in self.families})
        self.inside = {f[0]: Machines({x: vectors[x] for x in f}) for f in self.families}

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not _LETTER.search(text):
            return "und", 0.0
        grams = _grams(text)
        family, sure = self.top.choose(grams)
        language, surer = self.inside[family].choose(grams)
        return language, sure * surer


def families(vectors: dict[str, np.ndarray]) -> list[list[str]]:
    """Languages grouped by the cosine of their mean vectors, nearest first."""
    groups = [[name] for name in sorted(vectors)]
    means = {name: v.mean(axis=0) / np.linalg.norm(v.mean(axis=0)) for name, v in vectors.items()}
    near = lambda a, b: float(np.mean([means[x] @ means[y] for x in a for y in b]))
    while len(groups) > math.ceil(math.sqrt(len(vectors))):
        a, b = max(combinations(range(len(groups)), 2), key=lambda p: near(groups[p[0]], groups[p[1]]))
        groups[a] = sorted(groups[a] + groups.pop(b))
    return sorted(groups)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel | None:
    """Learn from the rows (doc_id, text, lang) given; None if no text has letters."""
    docs = docs.filter("doc_id is not null")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "key")
    labelled = docs.select("doc_id", "lang", F.xxhash64("text").alias("key")).filter("lang is not null")
    # The row number keeps per_language rows of each language in every task, then of all.
    chosen = labelled.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= per_language)
    chosen = keep(chosen.select("doc_id", "lang", "key").distinct(), "chosen")
    if chosen.count() <= _SENT:  # per_language for each language; texts then stay in place
        chosen = F.broadcast(chosen)
    texts = docs.filter("text is not null and lang is not null").select(
        "doc_id", "lang", "text", F.xxhash64("text").alias("key")
    )
    sample = texts.join(chosen, ["doc_id", "lang", "key"], "left_semi").select("lang", "text")
    rows = sample.mapInPandas(_vectors, "lang string, vector binary").collect()
    found: dict[str, list[bytes]] = {}
    for row in rows:
        found.setdefault(row["lang"], []).append(bytes(row["vector"]))
    if not found:
        return None
    # Sums of floats depend on their order, so it is fixed.
    return LanguageModel(
        {
            lang: np.frombuffer(b"".join(sorted(v)), np.float32).reshape(len(v), BUCKETS)
            for lang, v in found.items()
        }
    )


def identify(docs: DataFrame, model: LanguageModel | None, held_out) -> DataFrame:
    """lang_pred and score of each text; ``held_out`` marks rows that training left out."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            found = [model.predict(t) if model else ("und", 0.0) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "held_out": batch["held_out"],
                    "lang_pred": [f[0] for f in found],
                    "score": [f[1] for f in found],
                }
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held_out.alias("held_out"))
    return rows.mapInPandas(run, "doc_id bigint, held_out boolean, lang_pred string, score double")
