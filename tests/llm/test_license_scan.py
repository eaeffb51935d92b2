"""License notices against edit distances worked out cell by cell."""

import random
import re

import pytest

from roost.llm import license_scan as scan
from roost.llm.queries import QUERIES
from tests.conftest import SMALL

SCHEMA = "doc_id bigint, text string, labels string, score string, label int"


def least_edits(notice, text):
    """The fewest edits between a notice and any part of a text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(notice, 1):
        last, row = row, [i]
        for j, d in enumerate(text, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (c != d)))
    return min(row)


def altered(rng, text, edits):
    letters = list(text)
    for _ in range(edits):
        k = rng.randrange(len(letters))
        kind = rng.randrange(3)
        if kind == 0:
            letters[k] = rng.choice("abcxyz é")
        elif kind == 1:
            letters.insert(k, rng.choice("abcxyz é"))
        elif len(letters) > 1:
            del letters[k]
    return "".join(letters)


def filler(rng, n):
    return " ".join(rng.choice(["under", "the", "license", "public", "wörd", "x", "general", "mit"]) for _ in range(n))


def test_every_notice_within_its_edits_is_found():
    rng, some = random.Random(7), 0
    for i, notice in enumerate(scan.ALL):
        for edits in range(notice.edits + 3):
            words = scan.normal(f"{filler(rng, 12)} {altered(rng, notice.words, edits)} {filler(rng, 9)}")
            found = {}
            for _, _, n, k in scan.within_edits(words):
                found[k] = min(n, found.get(k, 99))
            for k, other in enumerate(scan.ALL):
                least = least_edits(other.padded, words)
                assert found.get(k) == (least if least <= other.edits else None), (words, other)
                some += k == i and k in found
    assert some > 60


def base_of(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [
        (k, label)
        for k in range(len(words))
        for label, phrase in scan.BASE
        if words[k : k + len(phrase.split())] == phrase.split()
    ]
    at = [k for k, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


TEXTS = [
    None,
    "",
    " .,-\n",
    "Released under the MIT License.",
    "relesed  under\nthe MIT-Licence!",
    "mit license MIT\tLICENSE mit licenses smit license",
    "THE GNU LESSER GENERAL PUBLIC LICENSE, an Apache License; general public license",
    "Éé mit license é ünder the GNU\nGeneral Pubic Licence",
    "limited licensees transmit licensed",
    "\0mit\0license\0",
    "x " * 50_000 + "mit license " * 3000 + "licensed under the appache license, version 2",
    "mit" * 100_000,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", "y", 1) for i, t in enumerate(TEXTS)]
    rows += [rows[3], (None, TEXTS[3], None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_awkward_texts(docs):
    rows = scan.license_report(docs).collect()
    assert len(rows) == len(TEXTS) + 3
    for r in rows:
        text = TEXTS[r.doc_id] if r.doc_id is not None else TEXTS[3] if r.n_words else None
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_of(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert (r.score == 1.0) if r.n_base else (0 <= r.score < 1)
    by_id = {r.doc_id: (r.labels, round(r.score, 2)) for r in rows if r.doc_id is not None}
    assert by_id[3] == ("mit", 1.0)
    assert by_id[4][0] == "mit" and 0.9 < by_id[4][1] < 1
    assert by_id[6] == ("apache,gpl,lgpl", 1.0)
    assert by_id[7] == ("gpl,mit", 1.0)
    assert by_id[8] == ("", 0.0)
    assert by_id[10][0] == "apache,mit"


def test_spans_give_the_text_back(docs):
    rows = scan.license_spans(docs).collect()
    for r in rows:
        if r.doc_id is not None:
            assert TEXTS[r.doc_id][r.start : r.start + r.length] == r.found
    found = {(r.label, r.found) for r in rows if r.doc_id in (4, 7)}
    assert found == {
        ("mit", "relesed  under\nthe MIT-Licence"),
        ("mit", "mit license"),
        ("gpl", "ünder the GNU\nGeneral Pubic Licence"),
    }


def test_the_query_over_the_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op13_license_scan"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_of(texts[r.doc_id])


def test_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert scan.license_report(empty).count() == 0 and scan.license_spans(empty).count() == 0
