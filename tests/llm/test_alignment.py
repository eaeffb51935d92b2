"""Alignment of two tokenizers against pairs counted one by one."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from roost.llm import alignment
from roost.llm.queries import QUERIES
from tests.conftest import SMALL

SCHEMA = "doc_id bigint, text string, n_a string, chunk string, pair int"
TEXTS = [
    None,
    "",
    " ",
    "plain words, twice plain words",
    "  two  spaces\tand\r\n\nlines ",
    "<|endoftext|> <s> </s> <unk> <0x41>",
    "a▁b",
    "Ünïcode 漢字かな 🙂👩‍👩‍👧 ﬁ ① ́x ​",
    "\0nul\x1c\x85",
    "a" * 20_000,
    "漢" * 3000,
    "ab" * 700 + " " * 900 + "\n" * 500,
    "x " * 30_000,
]


def brute(rows):
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    # Byte-level characters: printable ones stand for themselves, the rest from 256 on in order.
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {c: c for c in own} | {256 + k: c for k, c in enumerate(c for c in range(256) if c not in own)}
    docs = []
    for doc_id, text in rows:
        groups, whole = [], (" " + (text or "")).encode()
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(letters[ord(c)] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [
            bytes([i - 3]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b
        ]
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            ids_a, ids_b = [], []
        i = j = end_a = end_b = 0
        while i < len(ids_a):
            one, two = [], []
            while not one or end_a != end_b:
                if end_a <= end_b:
                    one.append(ids_a[i])
                    end_a += len(bytes_a[i])
                    i += 1
                else:
                    two.append(ids_b[j])
                    end_b += len(bytes_b[j])
                    j += 1
            groups.append((one, two))
        links = Counter()
        for one, two in groups:
            for x, n in Counter(one).items():
                for y, m in Counter(two).items():
                    links[x, y] += n * m
        docs.append((doc_id, len(ids_a), len(ids_b), groups, links))
    counts = Counter(pair for *_, links in docs for pair in links)
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for doc_id, n_a, n_b, groups, links in docs:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append(
            (
                doc_id,
                n_a,
                n_b,
                len(groups),
                sum(links.values()),
                sum(n for p, n in links.items() if counts[p] == most[p[0]]),
                sum(n * counts[p] for p, n in links.items()),
                hashlib.sha256(text.encode()).hexdigest() if n_a else "",
            )
        )
    return sorted(out, key=repr), counts, most


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    pool = "abcdef ABZ  \n\t.,-'’éßλ漢🙂́‍"
    texts = TEXTS + ["".join(rng.choice(pool) for _ in range(rng.randrange(1, 300))) for _ in range(200)]
    numbered = list(enumerate(texts))
    return numbered + [numbered[3], numbered[3], (None, "plain words"), (None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA).repartition(3)


def test_awkward_texts(docs, rows):
    assert rows_of(alignment.alignment(docs)) == brute(rows)[0]


def test_the_dictionary(docs, rows):
    _, counts, most = brute(rows)
    expected = {(x, y, n, n == most[x]) for (x, y), n in counts.items()}
    assert {tuple(r) for r in alignment.dictionary(docs).collect()} == expected


def test_groups_spell_the_text(docs, rows):
    texts, found = dict(rows), defaultdict(list)
    for r in alignment.token_groups(docs).collect():
        found[r.doc_id].append((r.group, r.start, r.length, r.a_ids, r.b_ids))
    expected = {r[0]: r[3] for r in brute([r for r in rows if r[0] is not None])[0]}
    for doc_id, groups in found.items():
        if doc_id in (None, 3):
            continue
        groups.sort()
        assert [g[0] for g in groups] == list(range(expected[doc_id]))
        assert [g[1] for g in groups] == [sum(g[2] for g in groups[:k]) for k in range(len(groups))]
        assert sum(g[2] for g in groups) == len(texts[doc_id].encode()) + 1


def test_small_chunks_and_blocks_give_the_same(spark, rows, monkeypatch):
    """The same code in this process, where its bounds can be set."""
    import pandas as pd

    monkeypatch.setattr(alignment, "CHUNK", 50)
    monkeypatch.setattr(alignment, "SLICE", 7)
    monkeypatch.setattr(alignment, "_CHARS", 500)
    monkeypatch.setattr(alignment, "_EXPANDED", 3)

    class Task:
        def partitionId(self):
            return 2

    monkeypatch.setattr(alignment.TaskContext, "get", lambda: Task())
    few = [r for r in rows if len(r[1] or "") < 2000 and r[0] is not None]
    batch = pd.DataFrame(few, columns=["doc_id", "text"])
    frames = list(alignment._chunked(alignment.BYTE_LEVEL, alignment.PIECES)([batch]))
    assert len({c for f in frames for c in f["chunk"]}) > 5
    table = [r for f in frames for r in f.where(f.notna(), None).itertuples(index=False)]
    pairs = Counter()
    for r in table:
        for pair, n in zip(r.pairs or [], r.holders or []):
            pairs[pair >> 16, pair & 0xFFFF] += n
    expected, counts, _ = brute(few)
    assert pairs == counts
    known = defaultdict(dict)
    for r in table:
        for k, pair in enumerate(r.pairs or []):
            known[r.chunk][r.first + k] = pair
    sums = Counter()
    for r in table:
        if r.linked is not None:
            for number, times in zip(*(x.tolist() for x in alignment.unpacked(r.linked))):
                pair = known[r.chunk][number]
                sums[r.doc_id] += times * counts[pair >> 16, pair & 0xFFFF]
    by_id = Counter()
    for r in expected:
        by_id[r[0]] += r[6]
    assert +sums == +by_id


def test_the_query_over_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert rows_of(QUERIES["op12_tokenizer_alignment"](spark, SMALL)) == brute(rows)[0]


def test_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert alignment.alignment(empty).count() == 0
    assert alignment.dictionary(empty).count() == 0 and alignment.token_groups(empty).count() == 0
