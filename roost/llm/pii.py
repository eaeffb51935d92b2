"""Personal data: base patterns, and further spans accepted by a trained classifier.

Base spans (email, ip, card, phone) come from fixed patterns and always stay. Candidates
for more are what looser patterns find: numbers that a base match swallowed and dropped,
spelled-out addresses, national ids, and secrets. Labelers vote on each candidate, yes, no
or abstain: its format (check digit, length, quotes), gazetteers (card ranges, calling
codes, key prefixes), the words before it, and its borders. Expectation-maximisation over
the counts of the vote patterns (at most 3^4) estimates how reliable each labeler is and so
the probability of each pattern. These are the soft labels of a logistic regression on
features of the span and its surroundings, fitted on the counts of feature combinations
(at most 5 * 17 * 4 * 4 * 2). Its weights go back into the plan as literals, and candidates
scored 0.5 or more that overlap no base span are added.

Everything that touches a text is an SQL expression on its row: no shuffle of texts, no
Python. Positions are code points. Patterns are written so that no start is tried twice and
no repetition recurses, so very long texts and tokens take linear time. Texts are read
around a span from chunks of them, and spans are walked in blocks, so that a text with very
many spans costs in proportion too, but for totals of whole blocks. Secrets have no greatest
length, so none leaves a tail behind; a run of 20 digits or more is no card.

Null text is empty. Repeated rows are treated one by one. Without any candidate nothing is
trained or added. Extra columns pass through ``redact_documents``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roost.llm.store import keep

# In the order of the contract; later kinds are found by candidates only.
KINDS = ("email", "ip", "card", "phone", "id", "secret")

#: The base patterns, possessive; a match may start only where a run starts or where the
#: match before ended, which is where the plain patterns start as well.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Cheap conditions that every text with a match meets.
_MAY = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": "+"}

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

CANDIDATE = (
    r"AKIA[0-9A-Z]{16,}+"
    r"|(?i:password|passwd|pwd)=[^\x20\x09-\x0D\"',;]{4,}+"
    r"|(?i:token|secret|api_key) ?= ?\"[0-9A-Za-z_-]{16,}+\""
    r"|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(]at[\])] ?[A-Za-z0-9-]++"
    r"(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]++)++"
    r"|\+[0-9]{1,3}[\x20.-]?\([0-9]{2,4}\)[\x20.-]?[0-9]{3,4}[\x20.-][0-9]{4}(?![0-9])"
    r"|\([0-9]{3}\)[\x20.-]?[0-9]{3}[.-][0-9]{4}(?![0-9])"
    r"|(?<![0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])"
    r"|(?<![0-9])[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9])"
    r"|(?<![0-9])[0-9]{13,19}(?![0-9])"
)
#: Cheap condition that every branch of ``CANDIDATE`` meets.
_MAY_CANDIDATE = r"AKIA|[0-9]{4}|=|[\[(]at[\])]"
_CUES = (
    r"(?i)(call|phone|tel|mobile|fax|card|visa|iban|mail|contact|reach|password|passwd|pwd|token"
    r"|secret|key|ssn|social|id|number)[^A-Za-z0-9]{0,4}$"
)
_BLOCK = 512
_CHUNK = 1024  # code points
_NEAR = 24


@dataclass(frozen=True)
class SpanModel:
    """Weights of the span classifier by feature and value."""

    bias: float
    weights: dict[str, dict[int, float]]
    reliability: dict[str, tuple[float, float]]


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("int"), lambda a, x: (a + x).cast("int"))


def _with_chunks(df: DataFrame, wanted: Column) -> DataFrame:
    """Add ``chunks``: ``body`` in pieces of ``_CHUNK``, where ``wanted``."""
    pieces = F.regexp_extract_all(F.col("body"), F.lit(rf"(?s).{{1,{_CHUNK}}}"), F.lit(0))
    return df.withColumn("chunks", F.when(wanted, pieces))


def _text_between(start: Column, end: Column) -> Column:
    """That part of ``body``; only the chunks it lies in are looked at."""
    first = F.floor(start / _CHUNK).cast("int")
    some = F.floor(F.greatest(end - 1, start) / _CHUNK).cast("int") - first + 1
    joined = F.array_join(F.slice(F.col("chunks"), first + 1, some), "")
    found = F.substring(joined, start - first * _CHUNK + 1, end - start)
    return F.when(end > start, found).otherwise(F.lit(""))


def _in_blocks(spans: Column) -> Column:
    """Runs of ``_BLOCK`` spans, sorted by start: (first start, greatest end, spans)."""
    run = lambda b: F.slice(spans, b * _BLOCK + 1, F.lit(_BLOCK))
    block = lambda own: F.struct(
        F.get(own, F.lit(0))["start"].alias("first"),
        F.array_max(F.transform(own, lambda s: s["end"])).alias("last"),
        own.alias("own"),
    )
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / _BLOCK).cast("int")), run)
    return F.when(F.size(spans) > 0, F.transform(runs, block))


def _with_spans(df: DataFrame, name: str, pattern: str, may: Column) -> DataFrame:
    """Add ``name``: (start, end, hit) of each match in ``body``, leftmost, not overlapping.

    What stands between the matches gives the positions. Running totals are taken over
    blocks, so that a text with very many matches does not cost their square.
    """
    body, n = F.col("body"), lambda part: f"{name}_{part}"
    df = df.withColumn(n("hits"), F.when(may, F.regexp_extract_all(body, F.lit(pattern), F.lit(0))))
    df = df.withColumn(
        n("gaps"),
        F.when(
            F.size(n("hits")) > 0, F.transform(F.split(body, pattern, -1), lambda gap: F.length(gap))
        ),
    )
    df = df.withColumn(
        n("steps"), F.zip_with(n("gaps"), n("hits"), lambda g, h: g + F.coalesce(F.length(h), F.lit(0)))
    )
    count = F.size(n("hits"))
    df = df.withColumn(
        n("blocks"),
        F.transform(
            F.sequence(F.lit(0), F.floor((count - 1) / _BLOCK).cast("int")),
            lambda b: _sum(F.slice(n("steps"), b * _BLOCK + 1, F.lit(_BLOCK))),
        ),
    )
    df = df.withColumn(
        n("before"), F.transform(n("blocks"), lambda x, b: _sum(F.slice(n("blocks"), F.lit(1), b)))
    )

    def place(hit: Column, i: Column) -> Column:
        block = F.floor(i / _BLOCK).cast("int")
        ahead = _sum(F.slice(n("steps"), block * _BLOCK + 1, i - block * _BLOCK))
        start = F.get(n("before"), block) + ahead + F.get(n("gaps"), i)
        return F.struct(
            start.cast("int").alias("start"), (start + F.length(hit)).cast("int").alias("end"), hit.alias("hit")
        )

    found = F.when(F.size(n("gaps")) > 0, F.transform(n("hits"), place))
    none = F.array().cast("array<struct<start:int,end:int,hit:string>>")
    df = df.withColumn(name, F.coalesce(found, none))
    return df.drop(*[n(part) for part in ("hits", "gaps", "steps", "blocks", "before")])


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(hit: Column) -> Column:
    """Digits pass the check; meant for a bounded number of digits."""
    figures = F.split(F.reverse(_digits(hit)), "")
    worth = lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        2 * d.cast("int") - F.when(d.cast("int") > 4, 9).otherwise(0)
    )
    return _sum(F.transform(F.filter(figures, lambda d: d != ""), worth)) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    count = F.length(_digits(hit))
    if kind == "ip":
        return hit.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.when(count.between(12, 19), _luhn(hit)).otherwise(F.lit(False))
    if kind == "phone":
        return count.between(9, 15)
    return F.lit(True)


def _tagged(kind: str, spans: Column) -> Column:
    tag = lambda s: F.struct(s["start"], F.lit(KINDS.index(kind)).alias("kind"), s["end"])
    return F.transform(spans, tag)


def _with_base(df: DataFrame) -> DataFrame:
    """Add ``base``: (start, kind, end), sorted. ``df`` has ``body``."""
    for kind, pattern in BASE.items():
        plain = kind in ("email", "phone")
        may = F.contains("body", F.lit(_MAY[kind])) if plain else F.col("body").rlike(_MAY[kind])
        df = _with_spans(df, kind, pattern, may)
        if kind != "email":
            df = df.withColumn(kind, F.filter(kind, lambda s: _valid(kind, s["hit"])))
    spans = F.sort_array(F.concat(*[_tagged(kind, F.col(kind)) for kind in BASE]))
    return df.withColumn("base", spans).drop(*BASE)


def _side(char: Column) -> Column:
    """0 nothing, 1 white space, 2 letter or digit, 3 other."""
    return (
        F.when(char == "", 0)
        .when(char.rlike(r"[\x20\x09-\x0D]"), 1)
        .when(char.rlike(r"[\p{L}\p{N}]"), 2)
        .otherwise(3)
    )


def _described(span: Column) -> Column:
    """Votes and features of a candidate."""
    hit, start, end = span["hit"], span["start"], span["end"]
    digits = _digits(hit)
    left = _text_between(F.greatest(start - _NEAR, F.lit(0)), start)
    before = F.substring(left, F.greatest(F.length(left), F.lit(1)), F.lit(1))
    after = _text_between(end, end + 1)
    kind = (
        F.when(hit.rlike(r"^AKIA|="), KINDS.index("secret"))
        .when(hit.rlike(r"[\[(]at[\])]"), KINDS.index("email"))
        .when(hit.rlike(r"^[+(]"), KINDS.index("phone"))
        .when(hit.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), KINDS.index("id"))
        .otherwise(KINDS.index("card"))
    )
    cue = left.rlike(_CUES)
    yes_no = lambda condition: F.when(condition, 1).otherwise(0)
    form = (
        F.when(hit.rlike(r"^[0-9 -]+$") & (F.length(digits) >= 13), yes_no(_luhn(hit)))
        .when(hit.rlike(r"^[+(]"), yes_no(F.length(digits).between(10, 15)))
        .when(hit.rlike(r"^AKIA|\"$"), 1)
        .when(hit.rlike(r"^[0-9]{3}-"), yes_no(~hit.rlike(r"^(000|666|9)|-00-|-0000$")))
        .otherwise(-1)
    )
    listed = (
        F.when(hit.rlike(r"^(4|5[1-5]|2[2-7]|3[47]|6011|65)[0-9 -]{12,}$"), 1)
        .when(hit.rlike(r"^\+(1|7|33|34|39|44|49|81|86|91)[^0-9]"), 1)
        .when(hit.rlike(r"^AKIA|(?i)^(password|passwd|pwd|token|secret|api_key)"), 1)
        .when(hit.rlike(r"(?i)dot[\])] ?(com|net|org|edu|gov|de|fr|es)$"), 1)
        .when(hit.rlike(r"^[0-9]{13,}$"), 0)
        .otherwise(-1)
    )
    context = F.when(cue, 1).when(before.rlike("[0-9]"), 0).otherwise(-1)
    joined = (_side(before) == 2) | (_side(after) == 2)
    return F.struct(
        start.alias("start"),
        kind.alias("kind"),
        end.alias("end"),
        form.alias("v_form"),
        listed.alias("v_listed"),
        context.alias("v_context"),
        yes_no(~joined).alias("v_border"),
        F.least(F.floor((end - start) / 4).cast("int"), F.lit(16)).alias("f_length"),
        _side(before).alias("f_left"),
        _side(after).alias("f_right"),
        cue.cast("int").alias("f_cue"),
    )


_VOTES = ("v_form", "v_listed", "v_context", "v_border")
_FEATURES = ("kind", "f_length", "f_left", "f_right", "f_cue")


def _with_candidates(df: DataFrame) -> DataFrame:
    """Add ``more``: described candidates that overlap no base span."""
    df = _with_spans(df, "loose", CANDIDATE, F.col("body").rlike(_MAY_CANDIDATE))
    df = _with_chunks(df, F.size("loose") > 0)
    df = df.withColumn("blocks", F.when(F.size("loose") > 0, _in_blocks(F.col("base"))))
    meet = lambda b, s: (b["start"] < s["end"]) & (s["start"] < b["end"])
    near = lambda block, s: (block["first"] < s["end"]) & (s["start"] < block["last"])
    free = lambda s: ~F.exists(
        "blocks", lambda block: near(block, s) & F.exists(block["own"], lambda b: meet(b, s))
    )
    kept = F.when(F.size("blocks") > 0, F.filter("loose", free)).otherwise(F.col("loose"))
    df = df.withColumn("more", F.transform(kept, _described))
    return df.drop("loose", "chunks", "blocks")


def _agreed(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[dict, dict]:
    """Probability that a candidate of each vote pattern is right, and each labeler's rates.

    Expectation-maximisation with votes independent given the truth. It starts from the
    majority and holds a weak belief that labelers are right four times of five.
    """
    votes = np.array([p for p, _ in patterns])
    counts = np.array([n for _, n in patterns], float)
    cast = votes >= 0
    truth = np.array([(v[c].mean() if c.any() else 0.5) for v, c in zip(votes, cast)]).clip(0.05, 0.95)
    for _ in range(50):
        yes, no = truth * counts, (1 - truth) * counts
        hit = (((votes == 1) * yes[:, None]).sum(0) + 8) / ((cast * yes[:, None]).sum(0) + 10)
        false = (((votes == 1) * no[:, None]).sum(0) + 2) / ((cast * no[:, None]).sum(0) + 10)
        prior = (yes.sum() + 1) / (counts.sum() + 2)
        rate = lambda p: np.where(cast, np.where(votes == 1, np.log(p), np.log(1 - p)), 0).sum(1)
        odds = np.log(prior / (1 - prior)) + rate(hit) - rate(false)
        truth = 1 / (1 + np.exp(-odds.clip(-30, 30)))
    rates = {name: (float(a), float(b)) for name, a, b in zip(_VOTES, hit, false)}
    return {p: float(t) for (p, _), t in zip(patterns, truth)}, rates


def _fitted(rows: list[tuple[tuple[int, ...], float, int]]) -> tuple[float, dict[str, dict[int, float]]]:
    """Logistic regression on one-hot features; rows are (values, sum of labels, count)."""
    index = {key: i for i, key in enumerate(sorted({(f, v) for r in rows for f, v in enumerate(r[0])}))}
    x = np.zeros((len(rows), len(index) + 1))
    x[:, -1] = 1
    for i, (values, _, _) in enumerate(rows):
        for f, v in enumerate(values):
            x[i, index[f, v]] = 1
    share = np.array([label / n for _, label, n in rows])
    weight = np.array([n for _, _, n in rows], float)
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), 1.0)
    penalty[-1] = 1e-6
    for _ in range(25):  # Newton steps
        p = 1 / (1 + np.exp(-(x @ w).clip(-30, 30)))
        slope = x.T @ (weight * (p - share)) + penalty * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        w -= np.linalg.solve(curve, slope)
    table: dict[str, dict[int, float]] = {name: {} for name in _FEATURES}
    for (f, v), i in index.items():
        table[_FEATURES[f]][v] = float(w[i])
    return float(w[-1]), table


def train(docs: DataFrame) -> SpanModel | None:
    """Fit the span classifier on the candidates of all documents; None without any."""
    df = docs.select(F.coalesce("text", F.lit("")).alias("body")).filter(F.col("body").rlike(_MAY_CANDIDATE))
    # Written first: what explode() asks of the array would be computed below every step of it.
    found = keep(_with_candidates(_with_base(df)).select("more"), "candidates")
    rows = found.select(F.explode("more").alias("c")).select("c.*")
    counted = rows.groupBy(*_VOTES, *_FEATURES).agg(F.count(F.lit(1)).alias("n")).collect()
    if not counted:
        return None
    patterns: dict[tuple[int, ...], int] = {}
    for row in counted:
        key = tuple(row[v] for v in _VOTES)
        patterns[key] = patterns.get(key, 0) + row["n"]
    truth, rates = _agreed(sorted(patterns.items()))
    combined: dict[tuple[int, ...], list[float]] = {}
    for row in sorted(counted, key=tuple):
        sums = combined.setdefault(tuple(row[f] for f in _FEATURES), [0.0, 0])
        sums[0] += truth[tuple(row[v] for v in _VOTES)] * row["n"]
        sums[1] += row["n"]
    bias, weights = _fitted([(k, s, n) for k, (s, n) in sorted(combined.items())])
    return SpanModel(bias, weights, rates)


def _accepted(model: SpanModel, candidate: Column) -> Column:
    def weight(feature: str) -> Column:
        found = F.lit(0.0)
        for value, w in model.weights[feature].items():
            found = F.when(candidate[feature] == value, F.lit(w)).otherwise(found)
        return found

    return reduce(add, [weight(f) for f in _FEATURES], F.lit(model.bias)) >= 0


def _with_all(df: DataFrame, model: SpanModel | None) -> DataFrame:
    """Add ``base`` and ``spans`` to rows with ``body``."""
    df = _with_base(df)
    if model is None:
        return df.withColumn("spans", F.col("base"))
    df = _with_candidates(df)
    added = F.transform(
        F.filter("more", lambda c: _accepted(model, c)), lambda c: F.struct(c["start"], c["kind"], c["end"])
    )
    return df.withColumn("spans", F.sort_array(F.concat("base", added))).drop("more")


def _joined(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    write = lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
    )
    return F.array_join(F.transform(spans, write), ",")


def find_personal_data(docs: DataFrame, model: SpanModel | None) -> DataFrame:
    """Counts and digest of base spans, and all spans as text, of each document."""
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("body"))
    df = _with_all(df, model)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
    return df.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
    )


def redact_documents(docs: DataFrame) -> DataFrame:
    """Documents with each span replaced by its kind in brackets; columns as given.

    Spans that overlap are replaced as one. ``n_chars`` follows the text.
    """
    model = train(docs)
    df = docs.select(F.struct("*").alias("row"), F.coalesce("text", F.lit("")).alias("body"))
    df = _with_all(df, model)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(done: Column, s: Column) -> Column:
        piece = F.concat(_text_between(done["at"], s["start"]), F.get(names, s["kind"]))
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(s["start"] < done["at"], done["out"])
            .otherwise(F.array_append(done["out"], piece))
            .alias("out"),
        )

    def written(block: Column, b: Column) -> Column:
        """A block of spans and the text before each, from where the blocks before end."""
        passed = F.array_max(F.transform(F.slice(F.col("blocks"), F.lit(1), b), lambda x: x["last"]))
        begin = F.struct(F.coalesce(passed, F.lit(0)).alias("at"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(block["own"], begin, step, lambda done: F.array_join(done["out"], ""))

    df = _with_chunks(df, F.size("spans") > 0).withColumn("blocks", _in_blocks(F.col("spans")))
    last = F.array_max(F.transform("blocks", lambda x: x["last"]))
    redacted = F.when(F.size("spans") == 0, F.col("row.text")).otherwise(
        F.concat(
            F.array_join(F.transform("blocks", written), ""), _text_between(last, F.length("body"))
        )
    )
    df = df.select("row", redacted.alias("redacted"))
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns}
    columns["text"] = F.col("redacted")
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        same = F.col("redacted").eqNullSafe(F.col("row.text"))
        columns["n_chars"] = F.when(same, F.col("row.n_chars")).otherwise(F.length("redacted").cast(kind))
    return df.select(*[column.alias(c) for c, column in columns.items()])
