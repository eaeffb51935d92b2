"""Cases at the edges of operators: long secrets, long lines, odd letters, rows without an id."""

import hashlib
import re
import time
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash

from checks.compare import connect, difference
from roost.llm import fingerprints, language, mixing, packing, pii, quality, token_counts, toxicity, url_filter
from roost.llm.oracle import ORACLE
from roost.llm.queries import QUERIES, _in_fold

TINY = "/root/testdata/sf0.001"

# Each kind of candidate, far beyond any length that one has in practice.
LONG = {
    "key": "AKIA" + "Q7" * 100,
    "password": "password=" + "hunter2!" * 80,
    "token": 'token = "' + "aZ09_-" * 220 + '"',
    "address": "a.b" * 220 + " (at) " + "mail" * 160 + " (dot) " + " (dot) ".join(["sub"] * 80) + " (dot) com",
}


@pytest.mark.parametrize("kind", LONG)
def test_no_tail_of_a_long_secret_stays(spark, kind):
    filler = [f"call 4111 1111 1111 1111 or password=abcd{i:04d} now" for i in range(40)]
    text = f"before {LONG[kind]} after"
    docs = spark.createDataFrame(list(enumerate([text, *filler])), "doc_id bigint, text string")
    found = {r.doc_id: r.text for r in pii.redact_documents(docs).collect()}
    assert re.fullmatch(r"before \[[A-Z]+\] after", found[0]), found[0][:200]


def test_a_run_of_digits_is_taken_whole_or_not_at_all(spark):
    texts = [f"card {'9' * n} end" for n in range(10, 30)] + ["id 991234 5678 9012 3456 end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in pii.redact_documents(docs).collect():
        assert r.text == texts[r.doc_id] or re.fullmatch(r"(card|id) \[[A-Z]+\] end", r.text), r.text


def test_long_lines_that_mention_notices_match_sql(spark):
    words = " ".join(f"word{i}" for i in range(124))
    texts = [f"{words} released under " + words.replace("word", "other"), "licensed under MIT", f"{words}\nall rights reserved", f"{words} terms of use " * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sql = connect(TINY)
    sql.execute("DROP VIEW documents")
    sql.register("documents", docs.toPandas())
    report = quality.quality_report(docs).drop("clean_text")
    assert difference(report, sql, ORACLE["op5_quality_rules"]) is None
    assert {r.doc_id: r.kept for r in report.collect()}[0]


def test_figures_are_not_letters():
    model = language.LanguageModel({"en": np.ones((2, language.BUCKETS), np.float32)})
    assert model.predict("½ ³ ² Ⅷ 12 _ !")[0] == "und" == model.predict(None)[0]
    assert {model.predict(t)[0] for t in ("é", "漢", "a1")} == {"en"}


def test_rows_without_an_id_are_in_no_fold_and_not_learned_from(spark):
    docs = spark.createDataFrame(
        [(None, "nur hier", "de"), (None, None, None)] + [(i, f"plain words {i}", "en") for i in range(9)],
        "doc_id bigint, text string, lang string",
    )
    held_out = _in_fold(1, 3)
    model = language.train(docs.filter(~held_out))
    assert [name for family in model.families for name in family] == ["en"]
    rows = language.identify(docs, model, held_out).collect()
    assert [r.held_out for r in rows if r.doc_id is None] == [False, False]
    labels = spark.createDataFrame([(None, 1), (1, 0)], "doc_id bigint, toxic int")
    assert toxicity.train(docs, labels.filter(~_in_fold(0, 5))) is None
    scored = toxicity.score(docs, None, _in_fold(0, 5)).collect()
    assert {r.held_out for r in scored if r.doc_id is None} == {False} and len(scored) == 11


def test_the_chosen_rows_are_sent_or_joined_alike(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"some words {i % 40}", "en" if i % 3 else "de") for i in range(90)], "doc_id bigint, text string, lang string")
    sent = language.train(docs, per_language=20)
    monkeypatch.setattr(language, "_SENT", 0)
    joined = language.train(docs, per_language=20)
    assert np.array_equal(sent.top.weights, joined.top.weights)


def plain_root(text):
    """The root by its definition, part by part."""
    digest = lambda kind, data: hashlib.sha256(kind + b"\0" + data).digest()
    lines = [line.encode() for line in text.split("\n")]
    lines = [line + b"\n" for line in lines[:-1]] + [line for line in lines[-1:] if line]
    starts = fingerprints.Tree(text).sections.tolist()
    nodes = [digest(b"paragraph", line) for line in lines]
    sections = [digest(b"section", b"".join(nodes[a:b])) for a, b in zip(starts, [*starts[1:], len(nodes)])]
    return digest(b"text", b"".join(sections)).hex()[:32]


def test_roots_cover_every_byte():
    base = "one two\nthree\n\nfour " + "five " * 50 + "\n\nsix"
    texts = [base, base + "\n", base.replace("five", "Five", 1), base[:-1], "", "\n", "é"]
    roots = [fingerprints.Tree(t).root() for t in texts]
    assert roots == [plain_root(t) for t in texts] and len(set(roots)) == len(texts)


def test_no_host_of_the_pages_is_in_the_labelled_table():
    hosts = duckdb.sql(
        f"SELECT DISTINCT regexp_extract(url, '://([^/?#]*)', 1) FROM '{TINY}/pages.parquet' "
        "UNION SELECT DISTINCT regexp_extract(url, '://([^/?#]*)', 1) FROM '/root/testdata/sf0.1/pages.parquet'"
    ).fetchall()
    name = lambda host: re.sub(r"\.example\.(com|net|org)$", "", re.sub(r"^(www|m|blog)\.", "", host))
    labelled = {name(a.partition("/")[0]) for side in url_filter.labelled() for a in side}
    assert not labelled & {name(h) for (h,) in hosts} - {"example.com", "example.net", "example.org"}


def test_addresses_against_each_worked_out_alone(spark):
    """Every row of ``pages``: host, path and verdict, the probability from the grams one by one."""
    weights = url_filter.train()
    rows = {r.page_id: r for r in QUERIES["op8_url_filter"](spark, TINY).collect()}
    pages = spark.read.parquet(f"{TINY}/pages.parquet").select("page_id", "url").collect()
    assert len(rows) == len(pages)
    for page_id, url in pages:
        rest = url.partition("://")[2] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        found = rows[page_id]
        assert (found.host, found.path) == (host, path)
        best = None
        for verdict, rule_host, rule_path in [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]:
            fits = (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path)
            if fits and (best is None or len(rule_host + rule_path) > len(best[1])):
                best = verdict, rule_host + rule_path
        assert found.rule == (best and best[1])
        if not best:
            grams = {g for field, text in (("host", host), ("path", path)) if text for g in url_filter._buckets(field, text)}
            total = sum(float(weights[g]) for g in grams) * (8 / len(grams) ** 0.5 if grams else 0) + float(weights[-1])
            best = ("block" if total >= 0 else "allow", None)
        assert found.verdict == best[0]


def test_tokens_of_each_line_one_by_one(spark):
    """Each token goes to the line that holds its middle byte, of two middle ones the earlier."""
    encoding, _ = token_counts._encoding(public_tokenizers.path(token_counts.TOKENIZER))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()}
    found = defaultdict(list)
    for r in QUERIES["op10_token_counts"](spark, TINY).collect():
        found[r.doc_id].append((r.section, r.n_tokens))
    assert set(found) == set(texts)
    for doc_id, text in texts.items():
        line_of = [k for k, line in enumerate((text or "").split("\n")) for _ in range(len(line.encode()) + 1)]
        counts, at = Counter(), 0
        for token in encoding.encode_ordinary(text or ""):
            n = len(encoding.decode_single_token_bytes(token))
            counts[line_of[at + (n - 1) // 2]] += 1
            at += n
        assert {k: n for k, n in found[doc_id] if n} == counts


def test_urls_empty_repeated_and_long(spark):
    schema = "page_id bigint, url string, host int, rule string"
    urls = [None, "", "no scheme", "http://A.com/x" * 3, "https://long.example.net/" + "é" * 200_000, "http://#", "://"]
    rows = [(i % 5, u, 1, "r") for i, u in enumerate(urls * 2)]
    weights = url_filter.train()
    found = url_filter.judge(spark.createDataFrame(rows, schema), [], weights)
    assert found.count() == len(rows) and {r.verdict for r in found.collect()} <= {"allow", "block"}
    assert url_filter.judge(spark.createDataFrame([], schema), [], weights).count() == 0


def test_cleaning_and_finding_on_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, n_chars bigint, row string, body string")
    assert quality.clean_documents(empty).count() == 0
    assert pii.find_personal_data(empty, pii.train(empty)).count() == 0
    assert pii.redact_documents(empty).count() == 0


def test_training_reads_long_words_to_their_end():
    """The insult stands behind the 28th character of its word."""
    word = "x" * 40 + "blockhead"
    texts = [(f"{word} number {i}", 1) for i in range(40)] + [(f"a lovely day number {i}", 0) for i in range(40)]
    sample = toxicity.Sentences(texts)
    kernel = toxicity.Kernel(["blockhead", "lovely"])
    sample.map(kernel, np.eye(2))
    row = sample.mapped[sample.words.index(word)]
    assert row[0] > 1e-4 > row[1]


def _laid_out_by_hand(rows, targets):
    """(taken words, positions) of each (doc_id, text, source), document by document."""
    found = {}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    for source, (target, shape) in targets.items():
        own = []
        for doc_id, text, s in rows:
            if s == source:
                key = 42 if text is None else signed(xxhash.xxh64(text.encode(), seed=42).intdigest())
                name = f"{'' if doc_id is None else doc_id}:{key}"
                own.append((hashlib.md5(name.encode()).hexdigest(), doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))))
        total, at = sum(size for *_, size in own), 0
        for _, doc_id, size in sorted(own, key=lambda row: row[0]):
            middles = [at + size / 2 + k * total for k in range(3)] if size else []
            met = [m for m in middles if m < target]
            found[doc_id] = (size * len(met), [_time_by_hand(m / target, shape) for m in met])
            at += size
    return found


def _time_by_hand(share, shape):
    """Bisection on the area below straight lines between evenly spaced weights."""
    def area(t):
        steps = np.linspace(0, t, 2001)
        return np.trapezoid(np.interp(steps, np.linspace(0, 1, len(shape)), shape), steps)
    low, high = 0.0, 1.0
    for _ in range(40):
        middle = (low + high) / 2
        low, high = (middle, high) if area(middle) < share * area(1.0) else (low, middle)
    return low


@pytest.mark.parametrize("per_slice", [1, mixing.PER_SLICE])
def test_what_the_mix_takes_and_where(spark, monkeypatch, per_slice):
    """Every document's passes and positions, in many slices and blocks and in few."""
    monkeypatch.setattr(mixing, "PER_SLICE", per_slice)
    docs = spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text", "source")
    more = [(-1, None, None), (-2, "", None), (-3, "one two three", None), (-4, "four", "A")]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    rows = [tuple(r) for r in docs.collect()]
    names = sorted({s for *_, s in rows if s is not None}) + [None]
    found = mixing.mixture(docs).collect()
    source_of = {doc_id: source for doc_id, _, source in rows}
    targets = {source_of[r.doc_id]: r.target for r in found}
    shapes = {s: mixing.SHAPES[names.index(s) % len(mixing.SHAPES)] for s in names}
    want = _laid_out_by_hand(rows, {s: (targets[s], shapes[s]) for s in names})
    assert len(found) == len(rows) == len(want)
    for r in found:
        taken, positions = want[r.doc_id]
        assert r.taken == taken, r.doc_id
        assert r.positions == pytest.approx(positions, abs=1e-4), r.doc_id


def test_places_are_the_training_order(spark):
    """Every pass has its rank among the passes of all sources, also with ids that repeat or
    are null, and documents leave the mix in that order."""
    docs = spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text", "source")
    more = [(7, "one two three", "z"), (7, "one two four", "z"), (None, "five", None), (None, None, None), (-1, "", "z")]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema)).repartition(7)
    found = mixing.mixture(docs).collect()
    assert len(found) == docs.count()
    assert all(len(r.places) == len(r.positions) for r in found)
    passes = sorted((place, position, r.doc_id) for r in found for place, position in zip(r.places, r.positions))
    assert [place for place, *_ in passes] == list(range(len(passes)))
    positions = [position for _, position, _ in passes]
    assert positions == sorted(positions) and len(passes) > len(docs.select("source").distinct().collect())
    assert [r.doc_id for r in mixing.mix_documents(docs).collect()] == [doc_id for *_, doc_id in passes]
    query = {r.doc_id: r.first_place for r in QUERIES["op2_source_mix"](spark, TINY).collect()}
    assert min(p for p in query.values() if p is not None) == 0


def test_slices_grow_with_the_rows():
    for rows in (0, 10, 10**6, 10**11):
        assert rows / 2 ** mixing.slice_bits(rows, mixing.PER_SLICE) <= mixing.PER_SLICE


def test_rows_of_one_id_lie_in_many_slices(spark):
    docs = spark.createDataFrame([(7, f"w{i} " * 3, "a") for i in range(300)] + [(None, f"v{i}", "a") for i in range(300)], "doc_id bigint, text string, source string")
    rows, _ = mixing._laid_out(docs)
    placed = rows.orderBy("start").collect()
    assert [r.start for r in placed] == [0, *np.cumsum([r["size"] for r in placed])[:-1]]
    order = [r.doc_id for r in placed]
    assert sum(a != b for a, b in zip(order, order[1:])) > 100


def _redacted_by_hand(text, spans):
    out, at = [], 0
    for kind, start, end in (s.split(":") for s in filter(None, spans.split(","))):
        start, end = int(start), int(end)
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _many_spans(count):
    kinds = ["a{0}@b{0}.co", "password=abcd{0:06d}", "9.8.7.6", "+49 30 {0:07d}", "4111-1111 1111 1111.9.9.9"]
    return " é𝄞 ".join(kinds[i % len(kinds)].format(i) for i in range(count))


def test_spans_across_chunks_and_blocks(spark):
    """Longer than many chunks, more spans than a block, against a plain walk."""
    texts = [_many_spans(n) for n in (1, 3, 700, 2500)]
    texts += [" " * k + "password=secret99 call +49 30 1234567" + "x" * (2050 - k) for k in range(1000, 1030)]
    texts += ["x" * 5000 + " jo@mail.org", "jo@mail.org", "+49 30 1234567 " * 600, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)
    spans = {r.doc_id: r.spans for r in pii.find_personal_data(docs, pii.train(docs)).collect()}
    for r in pii.redact_documents(docs).collect():
        assert r.text == _redacted_by_hand(texts[r.doc_id], spans[r.doc_id]), r.doc_id
    assert spans[2].count("secret") > 100 and spans[2].count("email") > 100


def test_time_is_in_proportion_to_the_spans(spark):
    def seconds(count):
        docs = spark.createDataFrame([(1, _many_spans(count))], "doc_id bigint, text string")
        started = time.perf_counter()
        (row,) = pii.redact_documents(docs).collect()
        assert row.text.count("[EMAIL]") == count // 5
        return time.perf_counter() - started
    seconds(1_000)
    few, many = seconds(10_000), seconds(100_000)
    print(few, many)
    assert many < 15 * few, (few, many)


def test_plain_words_are_encoded_piece_by_piece():
    """Words of ASCII and Latin-1 letters need no whole tokenizer, and get the ids it gives."""
    path = public_tokenizers.path(packing.TOKENIZER)
    plain = ["Été", "straße.%%%", "it's", "don't!", "a1b22", "mail5@example.com", "ÉÉÉ###", "|<", "'", "x" * 64]
    other = ["²", "½a", "e\u0301", "ª", "<|endoftext|>", "İx", "中", "a\u0085b", "a÷b", "x" * 65]
    words, whole = packing.WordIds(path), []
    encoded = words.encoded
    words.encoded = lambda word: whole.append(word) or encoded(word)
    for word in plain + other:
        assert words[word] == encoded(word), word
    assert whole == other
