"""Toxicity: a support vector machine on sentences with a subsequence string kernel.

The kernel of two words counts the character triples they share, in order but not
necessarily adjacent: a triple spanning more characters weighs less (``DECAY`` for each).
So an insult with inserted characters stays close to the plain one. The normalised kernel
is raised to ``POWER``; the kernel of a sentence and a word is the sum over its words.

Nyström: landmarks are words of the labelled sample, chosen for how much more often they
stand in toxic documents, far enough from each other, and ordinary words. Kernel values to
the landmarks, whitened by the kernel among them, are a sentence's coordinates for a linear
machine. Labels name documents, not sentences: clean documents give negative sentences, and
each toxic document its worst sentence by the machine so far, in ``ROUNDS`` rounds. As the
machine is linear, each word has one value, computed once and kept by each task. A
document's score is a logistic regression on its worst sentences, fitted on the sample.

Words are lower-cased runs without white space, marks taken out; three or single characters in a row count as one word as well. Sentences end with ``.!?``, a line
or after ``LONGEST`` words. Toxic landmarks with a character inserted join the positive
sentences, with little weight.

At most ``PER_LABEL`` labelled documents of each label are read for training, those of the
least id hashes. Every text is scored as a whole. Null and empty texts have one empty
sentence. Without both labels every score is 0. Repeated rows get equal scores; a document
labelled twice counts as toxic if one label says so. Rows without an id are scored but
never learned from, and not held out. Extra columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roost.llm.svm import fit_logistic, fit_svm, sigmoid

PER_LABEL = 2500
LANDMARKS = 160
DECAY = 0.95
GAP = 3  # farthest step between neighbouring characters of a triple
POWER = 3
HARDEST = 8  # sentences of each clean document that a round of training sees
ALTERED = 0.2  # weight of the altered insults, all toxic sentences weighing 1
ROUNDS = 3
LONGEST = 12
_PART = 28  # characters compared at a time; longer words are read in overlapping parts
_CHUNK = 1024  # words whose triples are held at a time
_CACHED = 1_000_000
_SYMBOLS = 1 << 6
_TRIPLES = _SYMBOLS**3
_MARKS = re.compile(r"[\W_]+")


def _codes(words: list[str]) -> np.ndarray:
    """A row of character classes for each word, 0 where it has ended."""
    out = np.zeros((len(words), max(map(len, words), default=1) or 1), np.int64)
    for row, word in enumerate(words):
        points = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        out[row, : len(points)] = 1 + (points * 2654435761 % (1 << 32) >> 16) % (_SYMBOLS - 1)
    return out


def _triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, triple, weight), one row for each word and triple, of unit length per word."""
    codes = _codes(words)
    keys, weights = [], []
    owner = np.arange(len(words), dtype=np.int64)[:, None] * _TRIPLES
    for first in range(1, GAP + 1):
        for second in range(1, GAP + 1):
            width = codes.shape[1] - first - second
            if width <= 0:
                continue
            a, b, c = codes[:, :width], codes[:, first : first + width], codes[:, first + second :]
            key = owner + (a * _SYMBOLS + b) * _SYMBOLS + c
            found = c > 0
            keys.append(key[found])
            weights.append(np.full(int(found.sum()), DECAY ** (first + second - 2)))
    if not keys:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0),)
    key, index = np.unique(np.concatenate(keys), return_inverse=True)
    weight = np.bincount(index, np.concatenate(weights), len(key))
    word = key // _TRIPLES
    length = np.sqrt(np.bincount(word, weight * weight, len(words)))
    return word, key % _TRIPLES, weight / length[word]


def plain(token: str) -> str:
    return _MARKS.sub("", token.lower())


class Kernel:
    """Kernel values of words to the landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        word, triple, weight = _triples(landmarks)
        used, column = np.unique(triple, return_inverse=True)
        # Triples that no landmark has need no row.
        self.used = used
        self.table = np.zeros((len(used), len(landmarks)), np.float32)
        self.table[column, word] = weight

    def __call__(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        for start in range(0, len(words), _CHUNK):
            chunk = words[start : start + _CHUNK]
            word, triple, weight = _triples(chunk)
            at = np.searchsorted(self.used, triple).clip(max=max(len(self.used) - 1, 0))
            if not len(self.used):
                continue
            hit = self.used[at] == triple
            word, at, weight = word[hit], at[hit], weight[hit]
            if not len(word):
                continue
            rows = self.table[at] * weight[:, None].astype(np.float32)
            firsts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            out[start + word[firsts]] = np.add.reduceat(rows, firsts, axis=0)
        return out**POWER


def parts_of(word: str) -> list[str]:
    if len(word) <= _PART:
        return [word]
    return [word[i : i + _PART] for i in range(0, len(word) - _PART // 2, _PART // 2)]


def sentence_starts(ends: np.ndarray) -> np.ndarray:
    """First word of each sentence: after an end, and after ``LONGEST`` words."""
    starts = np.concatenate(([0], np.flatnonzero(ends[:-1]) + 1))
    sizes = np.diff(np.append(starts, len(ends)))
    if sizes.max() <= LONGEST:
        return starts
    return np.concatenate([np.arange(s, s + n, LONGEST) for s, n in zip(starts, sizes)])


def tokens_of(text: str | None) -> list[str]:
    """Tokens, lines ended by one of their own, runs of single characters put together."""
    tokens = (text or "").replace("\n", " . ").split()
    if " " not in (text or "") or not _SPELLED.search(text):
        return tokens
    out, run = [], []
    for token in [*tokens, ""]:
        if len(plain(token)) == 1:
            run.append(token)
            out.append(token)
            continue
        if len(run) >= 3:
            out.append("".join(map(plain, run)))
        run = []
        if token:
            out.append(token)
    return out


_SPELLED = re.compile(r"(?<!\S)\w\W{1,3}\w\W{1,3}\w(?!\w)")
_ENDS = (".", "!", "?")
_INSERTED = "x1e"


def summary(values: np.ndarray) -> list[float]:
    """A document by its sentences' values: the worst, the next, the fourth, and how many."""
    worst = np.full(4, -2.0)
    top = np.sort(np.partition(values, len(values) - 4)[-4:] if len(values) > 4 else values)[::-1]
    worst[: len(top)] = top.clip(-2, 2)
    share = np.maximum(values.clip(-2, 2) + 1, 0).mean()
    return [worst[0], worst[1], worst[3], share, np.log1p(len(values))]


class ToxicityModel:
    def __init__(self, kernel: Kernel, values: np.ndarray, bias: float, document: np.ndarray):
        self.kernel, self.values, self.bias, self.document = kernel, values, bias, document

    def probability(self, summaries: np.ndarray) -> np.ndarray:
        return sigmoid(summaries @ self.document[:-1] + self.document[-1])

    def word_values(self, words: list[str]) -> np.ndarray:
        """What each token adds to its sentence; of a long one, its worst part."""
        parts = [parts_of(plain(word)) for word in words]
        flat = self.kernel([p for own in parts for p in own]) @ self.values
        firsts = np.cumsum([0, *map(len, parts[:-1])])
        return np.maximum.reduceat(flat, firsts) if len(flat) else flat


class Scorer(dict):
    """Scores texts, keeping the values of tokens met before."""

    def __init__(self, model: ToxicityModel):
        super().__init__()
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.values, self.ends = np.zeros(0, np.float32), np.zeros(0, bool)

    def __missing__(self, token: str) -> int:
        self[token] = at = len(self)
        self.new.append(token)
        return at

    def _learn(self) -> None:
        if self.new:
            self.values = np.append(self.values, self.model.word_values(self.new).astype(np.float32))
            self.ends = np.append(self.ends, [token.endswith(_ENDS) for token in self.new])
            self.new = []

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """The score of each text."""
        out = []
        for start in range(0, len(texts), 256):
            if len(self) > _CACHED:
                self.reset()
            places = []
            for text in texts[start : start + 256]:
                tokens = tokens_of(text) or [""]
                places.append(np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens)))
            self._learn()
            for at in places:
                sums = np.add.reduceat(self.values[at].astype(np.float64), sentence_starts(self.ends[at]))
                out.append(summary(sums + self.model.bias))
        return self.model.probability(np.array(out)) if out else np.empty(0)


def _chosen_landmarks(toxic: Counter, clean: Counter, many: int, others: int, count: int) -> tuple[list[str], set[str]]:
    """Landmarks, and which of them speak for toxicity: words by how much more often toxic documents hold them, then common clean ones."""
    others = max(1, others)
    least = 3 if many >= 30 else 1
    contrast = {
        w: n * np.log((n / many) / ((clean[w] + 0.5) / others))
        for w, n in toxic.items()
        if n >= least and n / many > 2 * clean[w] / others and len(w) >= 3
    }
    ranked = sorted(contrast, key=lambda w: (-contrast[w], w))[: 8 * count]
    common = [w for w, _ in sorted(clean.items(), key=lambda x: (-x[1], x[0])) if len(w) >= 3]
    picked: list[str] = []
    for pool, size in ((ranked, 3 * count // 4), (common[: 4 * count], count)):
        for word in pool:
            if len(picked) >= size:
                break
            if len(word) <= _PART and (not picked or (Kernel(picked)([word]) ** (1 / POWER)).max() < 0.85):
                picked.append(word)
    return picked, set(contrast)


class Sentences:
    """Sentences of the sample, as numbers of their words; vectors only of those asked for."""

    def __init__(self, texts: list[tuple[str, int]]):
        numbers: dict[str, int] = {}
        self.counts = {0: Counter(), 1: Counter()}
        ids, starts, owner = ([np.empty(0, np.int32)] for _ in range(3))
        labels, at = [], 0
        for text, label in texts:
            tokens = tokens_of(text)
            if not tokens:
                continue
            words = [plain(t) for t in tokens]
            self.counts[label].update({*words} - {""})
            first = sentence_starts(np.array([t.endswith(_ENDS) for t in tokens]))
            ids.append(np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int32))
            starts.append(first + at)
            owner.append(np.full(len(first), len(labels)))
            labels.append(label)
            at += len(words)
        self.labels, self.words = np.array(labels), list(numbers)
        self.ids, self.starts, self.owner = map(np.concatenate, (ids, starts, owner))
        self.stops = np.append(self.starts[1:], len(self.ids))

    def map(self, kernel: Kernel, whiten: np.ndarray) -> None:
        self.mapped = np.zeros((len(self.words), whiten.shape[1]), np.float32)
        for start in range(0, len(self.words), 8192):
            some = self.words[start : start + 8192]
            # Of a long word, the part closest to each landmark.
            parts = [parts_of(w) for w in some]
            near = kernel([p for own in parts for p in own])
            firsts = np.cumsum([0, *map(len, parts[:-1])])
            self.mapped[start : start + len(some)] = np.maximum.reduceat(near, firsts) @ whiten

    def values(self, weights: np.ndarray) -> np.ndarray:
        """The product of each sentence's vector with ``weights``."""
        return np.add.reduceat((self.mapped @ weights)[self.ids], self.starts)

    def vectors(self, chosen: np.ndarray) -> np.ndarray:
        out = np.zeros((len(chosen), self.mapped.shape[1]), np.float32)
        for start in range(0, len(chosen), 2048):
            some = chosen[start : start + 2048]
            sizes = self.stops[some] - self.starts[some]
            firsts = np.cumsum(sizes) - sizes
            at = np.arange(sizes.sum()) + np.repeat(self.starts[some] - firsts, sizes)
            out[start : start + len(some)] = np.add.reduceat(self.mapped[self.ids[at]], firsts, axis=0)
        return out


def fit(texts: list[tuple[str, int]], landmarks: int = LANDMARKS) -> ToxicityModel | None:
    """Train on labelled texts; None unless both labels occur."""
    if len({label for _, label in texts}) < 2:
        return None
    sample = Sentences(texts)
    labels, owner = sample.labels, sample.owner
    many = int(labels.sum())
    picked, insults = _chosen_landmarks(sample.counts[1], sample.counts[0], many, len(labels) - many, landmarks)
    if not insults:
        return None
    kernel = Kernel(picked)
    among = kernel(picked).astype(np.float64)
    size, turn = np.linalg.eigh(among + 1e-3 * np.eye(len(picked)))
    whiten = turn / np.sqrt(size.clip(1e-3))
    sample.map(kernel, whiten)
    firsts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    lasts = [*firsts[1:], len(owner)]

    # To begin with, the worst sentence of a document is the one closest to a toxic word.
    near = np.array([1.0 if w in insults else 0.0 for w in picked])
    toxic = [i for i, w in enumerate(picked) if w in insults]
    values = sample.values(np.linalg.pinv(whiten) @ near)
    altered = [w[:i] + c + w[i:] for k in toxic for w in [picked[k]] for c in _INSERTED for i in range(1, len(w))]
    altered = kernel(altered) @ whiten
    clean = labels[owner] == 0
    for _ in range(ROUNDS):
        worst = np.array([s + values[s:e].argmax() for s, e in zip(firsts, lasts)])
        # Of a clean document, the sentences most like an insult so far say the most.
        order = np.lexsort((-values, owner))
        at = np.arange(len(owner)) - np.repeat(firsts, np.diff(np.append(firsts, len(owner))))
        hardest = order[(at < HARDEST) & clean[order]]
        positive, negative = sample.vectors(worst[labels == 1]), sample.vectors(hardest)
        sizes = [len(positive), len(altered), len(negative)]
        weight = np.repeat([1 / sizes[0], ALTERED / sizes[1], 1 / max(1, sizes[2])], sizes) * sum(sizes) / 2
        y = np.repeat([1.0, 1.0, -1.0], sizes)
        w = fit_svm(np.vstack([positive, altered, negative]), y, 0.5, weight)
        values = sample.values(w[:-1])
    values += w[-1]
    summaries = [summary(values[s:e]) for s, e in zip(firsts, lasts)]
    document = fit_logistic(np.array(summaries), labels.astype(float), 0.01)
    return ToxicityModel(kernel, (whiten @ w[:-1]).astype(np.float32), float(w[-1]), document)


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> ToxicityModel | None:
    """Learn from the documents (doc_id, text) that ``labels`` (doc_id, toxic) names."""
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    pick = lambda label: (
        known.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
    )
    chosen = pick(1).unionByName(pick(0))
    # At most per_label rows of each label, so the broadcast is bounded.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")
    found = sorted((r["doc_id"], r["text"] or "", int(r["toxic"])) for r in rows.toLocalIterator())
    return fit([(text, label) for _, text, label in found])


_SCORERS: dict[str, Scorer] = {}


def _scorer(key: str, model: ToxicityModel) -> Scorer:
    """The scorer of a model, one at a time, kept for the next task of the same worker."""
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(model)
    return _SCORERS[key]


def score(docs: DataFrame, model: ToxicityModel | None, held_out) -> DataFrame:
    """Score and prediction of each text; ``held_out`` marks rows that training left out."""
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = None if shared.value is None else _scorer(key, shared.value)
        for batch in batches:
            scores = np.zeros(len(batch)) if scorer is None else scorer(list(batch["text"]))
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "held_out": batch["held_out"],
                    "score": scores,
                    "predicted": (scores >= 0.5).astype(np.int32),
                }
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held_out.alias("held_out"))
    return rows.mapInPandas(run, "doc_id bigint, held_out boolean, score double, predicted int")
