"""License notices in texts, found even where they are misspelled or broken over lines.

A text is read as its words, lower-cased and one space apart, so marks, line feeds and
capitals do not matter. A notice may differ from it by one inserted, lost or changed
character in each ``PER_EDIT`` of its own. With k edits allowed a notice is cut into k + 1
pieces, of which one at least stands there unchanged: one automaton finds the pieces of all
notices in a single walk over the text, and where one stands, the ``regex`` library matches
the notice with at most k errors in the window around it and reports the best span. Windows
are not merged, so the cost of a text is in proportion to the pieces it holds; equal windows
are matched once in a task as long as ``_SEEN`` others do not come between.

Three short phrases allow no edit; each place of theirs counts, overlapping ones too.

Null text is empty. Empty and wordless texts have no word, no place, no label and score 0.
Every row is answered for itself: repeated rows and rows without an id give a row each,
extra columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PER_EDIT = 10
# Phrases of the contract, and short notices of common licenses, as words.
BASE = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
NOTICES = [
    ("agpl", "gnu affero general public license"),
    ("apache", "licensed under the apache license version"),
    ("apache", "under the terms of the apache license"),
    ("apache", "the apache software license version"),
    ("boost", "boost software license version"),
    ("bsd", "redistribution and use in source and binary forms"),
    ("bsd", "licensed under the bsd license"),
    ("bsd", "released under the bsd license"),
    ("cc", "licensed under creative commons attribution"),
    ("cc", "licensed under cc by"),
    ("cc", "released under cc by"),
    ("cc", "licensed under a creative commons"),
    ("cc0", "released under creative commons zero"),
    ("cc0", "dedicated this work to the public domain"),
    ("epl", "under the eclipse public license"),
    ("gpl", "under the gnu general public license"),
    ("gpl", "under the terms of the gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software"),
    ("lgpl", "gnu lesser general public license"),
    ("lgpl", "gnu library general public license"),
    ("mit", "permission is hereby granted free of charge to any person"),
    ("mit", "licensed under the mit license"),
    ("mit", "released under the mit license"),
    ("mit", "distributed under the mit license"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("mpl", "under the mozilla public license"),
    ("reserved", "all rights reserved worldwide"),
    ("unlicense", "free and unencumbered software released into the public domain"),
]

# Digits, a-z and other characters' bytes stay, A-Z become a-z, the rest parts words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_SEEN = 1 << 16


@dataclass(frozen=True)
class Notice:
    label: str
    words: str
    edits: int

    @property
    def padded(self) -> str:
        """With the spaces around it, so that it begins and ends with whole words."""
        return f" {self.words} "

    def pieces(self) -> list[tuple[int, str]]:
        """(offset, piece), one more than edits, of nearly equal length."""
        text, n = self.padded, self.edits + 1
        cuts = [len(text) * i // n for i in range(n + 1)]
        return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


ALL = [Notice(label, words, 0) for label, words in BASE] + [
    Notice(label, words, len(words) // PER_EDIT) for label, words in NOTICES
]
_LONGEST = max(len(notice.padded) + notice.edits for notice in ALL)


@lru_cache(maxsize=1)
def _seeds() -> ahocorasick.Automaton:
    """Pieces of all notices; each leads to (notice, offset of the piece's end)."""
    places: dict[str, list[tuple[int, int]]] = {}
    for i, notice in enumerate(ALL):
        for offset, piece in notice.pieces():
            places.setdefault(piece, []).append((i, offset + len(piece)))
    automaton = ahocorasick.Automaton()
    for piece, uses in places.items():
        automaton.add_word(piece, uses)
    automaton.make_automaton()
    return automaton


@lru_cache(maxsize=len(ALL))
def _pattern(i: int) -> regex.Pattern:
    return regex.compile(f"(?b)(?:{regex.escape(ALL[i].padded, literal_spaces=True)}){{e<={ALL[i].edits}}}")


@lru_cache(maxsize=_SEEN)
def _verified(i: int, window: str) -> tuple[int, int, int] | None:
    """Start, end and edits of the best match in a window."""
    match = _pattern(i).search(window)
    return match and (*match.span(), sum(match.fuzzy_counts))


def normal(text: str | None) -> str:
    """The words, one space apart and around; a single space without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()
    return b" ".join([b"", *words, b""]).decode("utf-8", "surrogatepass") if words else " "


def within_edits(words: str) -> list[tuple[int, int, int, int]]:
    """Start, end, edits and number of each notice that a text as ``normal`` gives it holds."""
    found = set()
    for last, uses in _seeds().iter(words):
        for i, offset in uses:
            notice = ALL[i]
            begin = max(0, last + 1 - offset - notice.edits)
            window = words[begin : last + 1 - offset + len(notice.padded) + notice.edits]
            if len(window) < len(notice.padded) - notice.edits:
                continue
            match = _verified(i, window)
            if match:
                found.add((begin + match[0], begin + match[1], match[2], i))
    return sorted(found)


def matches(words: str) -> list[tuple[int, int, int, int]]:
    """The same without those that overlap a closer match of another label.

    "released under the mit license" is three edits from the same words with bsd.
    """
    found, kept, open_from = within_edits(words), [], 0
    for start, end, edits, i in found:
        # No match is longer than _LONGEST, so those that end before this one begin are behind.
        while found[open_from][0] + _LONGEST <= start:
            open_from += 1
        closer, k = False, open_from
        while not closer and k < len(found) and found[k][0] < end - 1:
            other = found[k]
            k += 1
            closer = other[1] - 1 > start and other[2] < edits and ALL[other[3]].label != ALL[i].label
        if not closer:
            kept.append((start, end, edits, i))
    return kept


def _reported(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    exact = len(BASE)
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            words = normal(text)
            found = matches(words)
            base = [m for m in found if m[3] < exact]
            places = [words.count(" ", 0, m[0]) for m in (base[:1] + base[-1:])]
            base_labels = sorted({ALL[m[3]].label for m in base})
            labels = sorted({ALL[m[3]].label for m in found})
            score = max((1 - m[2] / len(ALL[m[3]].words) for m in found), default=0.0)
            rows.append(
                (
                    doc_id,
                    words.count(" ") - 1,
                    len(base),
                    places[0] if base else None,
                    places[1] if base else None,
                    ",".join(base_labels),
                    ",".join(labels),
                    float(score),
                )
            )
        names = [c.split()[0] for c in _REPORT.split(", ")]
        frame = pd.DataFrame(rows, columns=names)
        yield frame.astype({"doc_id": "Int64", "first_word": "Int64", "last_word": "Int64"})


_REPORT = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "base_labels string, labels string, score double"
)
_SPANS = "doc_id bigint, label string, notice string, start bigint, length bigint, edits int, found string"


def _best(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Of overlapping matches of one label the one with fewest edits, then the longest."""
    kept: list[tuple[int, int, int, int]] = []
    for match in sorted(found, key=lambda m: (ALL[m[3]].label, m[0], m[1])):
        last = kept[-1] if kept and ALL[kept[-1][3]].label == ALL[match[3]].label else None
        if last and match[0] < last[1] - 1:
            if (match[2], last[0] - last[1]) < (last[2], match[0] - match[1]):
                kept[-1] = match
        else:
            kept.append(match)
    return kept


def _located(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            words = normal(text)
            found = _best(matches(words))
            if not found:
                continue
            spans = [m.span() for m in _WORD.finditer(text)]
            gaps = [k for k, c in enumerate(words) if c == " "]
            number = {at: k for k, at in enumerate(gaps)}
            for start, end, edits, i in found:
                # A match may begin or end inside a word if an edit took its space.
                first = number[words.rindex(" ", 0, start + 1)]
                last = number[words.index(" ", end - 1)] - 1
                a, b = spans[min(first, len(spans) - 1)][0], spans[last][1]
                rows.append((doc_id, ALL[i].label, ALL[i].words, a, b - a, edits, text[a:b]))
        names = [c.split()[0] for c in _SPANS.split(", ")]
        yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


def license_spans(docs: DataFrame) -> DataFrame:
    """Every notice found: label, the notice it comes from, place in code points, edits, text."""
    return _rows(docs).mapInPandas(_located, _SPANS)


def license_report(docs: DataFrame) -> DataFrame:
    """Words, exact phrases and their places, all labels, and how close the best match is."""
    return _rows(docs).mapInPandas(_reported, _REPORT)
