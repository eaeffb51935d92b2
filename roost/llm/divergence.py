"""Source divergence audit: how far the sources of a language differ in their words.

The texts are read twice. The first pass counts in how many documents of its language each
term stands; those in ``FEW`` documents or more are kept. Kept terms are dealt to shards by
hash, and a task builds the minimal perfect hash of each shard (see ``perfect_hash``). The
second pass gets the shards as a broadcast and adds up one dense array of slots for each
(lang, source) group; what is not a key of its slot is passed over. A broadcast holds about
``WAVE`` keys, at most 1.25 times as many (measured before it is sent), of at most 33 bytes
with about 12 bytes of table; a greater vocabulary is counted in several waves, each reading
the texts again. Tasks hand over their arrays shard by shard; what meets in a task is one
shard of one language, at most ``CELLS`` slots over all sources unless a shard is down to
``LEAST_KEYS`` keys, from at most ``FAN`` tasks (more are added up in steps).

A probability is p = 1 + floor(10^9 * (count + 1) / (N + V)), in whole numbers of a
billionth: count is the term's in the group or the language, N the sum of counts over kept
terms, V the number of kept terms. The divergence of p from q is the sum of
floor((p - q)^2 / q). ``pair`` rows compare a source with each other source of its language,
``term`` rows list the ``TOP`` terms by which it stands out from its language.

Null text, lang and source are ''. Every row counts as a document, repeated rows too; ids
and extra columns are not read. A language without a kept term has pairs of value 0. An
empty table gives no rows.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roost.llm.perfect_hash import PerfectHash, Shard, stored
from roost.llm.store import keep

FEW = 3
TOP = 200
SCALE = 1_000_000_000
SHARD_KEYS, LEAST_KEYS = 4096, 64
CELLS = 1 << 18
WAVE = 2_000_000
FAN = 256
_SALTS = 512
_RUN = 16  # shards of a language that meet its totals in one task
_HELD_TERMS = 400_000
_HELD_SLOTS = 8_000_000

# Lower-case letters stay, A-Z become them, bytes of other characters stay, the rest ends a term.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_PART = "lang string, source string, shard bigint, part bigint, total bigint, slots binary"


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def _holding(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """lang, term, documents holding it, added up within the task."""
    held: dict[str, Counter] = {}

    def flush() -> Iterator[pd.DataFrame]:
        for lang, counts in held.items():
            yield pd.DataFrame({"lang": lang, "term": list(counts), "n": list(counts.values())})
        held.clear()

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            held.setdefault(lang, Counter()).update(set(terms_of(text)))
            if sum(map(len, held.values())) > _HELD_TERMS:
                yield from flush()
    yield from flush()


def _built(rows: pd.DataFrame) -> pd.DataFrame:
    terms = sorted(rows["term"])
    shard = Shard.build(terms)
    by_slot = [b""] * len(terms)
    for slot, term in zip(shard.slots(terms).tolist(), terms):
        by_slot[slot] = term
    first = rows.iloc[0]
    keys = [stored(term) for term in by_slot]
    return pd.DataFrame(
        {
            "lang": [first["lang"]],
            "shard": [first["shard"]],
            "shards": [first["shards"]],
            "n": [len(terms)],
            "seed": [shard.seed],
            "sizes": [shard.sizes.tobytes()],
            "words": [shard.words.tobytes()],
            "lengths": [bytes(map(len, keys))],
            "keys": [b"".join(keys)],
            "terms": [by_slot],
        }
    )


def _loaded(rows: list) -> dict[str, PerfectHash]:
    """The shards of each language in a broadcast, as one perfect hash."""
    langs: dict[str, list] = {}
    for row in rows:
        langs.setdefault(row["lang"], []).append(row)
    loaded = {}
    for lang, of_lang in langs.items():
        of_lang.sort(key=lambda r: r["shard"])
        parts = [
            Shard(r["seed"], np.frombuffer(r["sizes"], np.int32), np.frombuffer(r["words"], "<u8"))
            for r in of_lang
        ]
        keys = []
        for r in of_lang:
            ends = np.cumsum(np.frombuffer(r["lengths"], np.uint8), dtype=np.int64).tolist()
            keys.append([r["keys"][a:b] for a, b in zip([0, *ends], ends)])
        numbers = [r["shard"] for r in of_lang]
        loaded[lang] = PerfectHash(parts, numbers, of_lang[0]["shards"], keys)
        loaded[lang].numbers = numbers
    return loaded


def packed(counts: np.ndarray) -> bytes:
    """The slots of an array that are not 0."""
    at = np.flatnonzero(counts)
    return zlib.compress(at.astype("<u4").tobytes() + counts[at].astype("<i8").tobytes(), 1)


def add_packed(into: np.ndarray, data: bytes) -> None:
    raw = zlib.decompress(data)
    n = len(raw) // 12
    into[np.frombuffer(raw, "<u4", n)] += np.frombuffer(raw, "<i8", n, 4 * n)


# One loaded wave for each Python worker, which tasks of the same wave share.
_WAVE: dict[str, dict[str, PerfectHash]] = {}


def _recounted(wave: Broadcast):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, shards = wave.value
        if name not in _WAVE:
            _WAVE.clear()
            _WAVE[name] = _loaded(shards)
        found = _WAVE[name]
        part = TaskContext.get().partitionId()
        held: dict[tuple[str, str], np.ndarray] = {}

        def flush() -> Iterator[pd.DataFrame]:
            rows = []
            for (lang, source), counts in held.items():
                table = found[lang]
                for i, shard in enumerate(table.numbers):
                    of_shard = counts[table.starts[i] : table.starts[i + 1]]
                    total = int(of_shard.sum())
                    if total:
                        rows.append((lang, source, shard, part, total, packed(of_shard)))
            held.clear()
            if rows:
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in _PART.split(", ")])

        for batch in batches:
            for (lang, source), rows in batch.groupby(["lang", "source"], sort=False):
                if lang not in found:
                    continue
                seen = Counter()
                for text in rows["text"]:
                    seen.update(terms_of(text))
                if not seen:
                    continue
                slots = found[lang].slots(list(seen))
                times = np.fromiter(seen.values(), np.int64, len(seen))
                counts = held.get((lang, source))
                if counts is None:
                    size = int(found[lang].starts[-1])
                    if held and size + sum(map(len, held.values())) > _HELD_SLOTS:
                        yield from flush()
                    counts = held[lang, source] = np.zeros(size, np.int64)
                counts[slots[slots >= 0]] += times[slots >= 0]
        yield from flush()

    return run


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows of one group and shard from several tasks, as one."""
    counts = np.zeros(0, np.int64)
    for data in rows["slots"]:
        raw = zlib.decompress(data)
        size = 1 + int(np.frombuffer(raw, "<u4", len(raw) // 12).max())
        if size > len(counts):
            counts = np.concatenate((counts, np.zeros(size - len(counts), np.int64)))
        add_packed(counts, data)
    first = rows.iloc[:1].copy()
    first["total"] = int(rows["total"].sum())
    first["slots"] = [packed(counts)]
    return first[[c.split()[0] for c in _PART.split(", ")]]


def probabilities(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(SCALE * (counts + 1) / (total + kept)), by long division to base 1000."""
    over, rest = np.zeros_like(counts), counts + 1
    for _ in range(3):
        rest = rest * 1000
        over = over * 1000 + rest // (total + kept)
        rest = rest % (total + kept)
    return over + 1


def divergences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _compared(key: tuple, counts: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
    """Shares of one shard in the values of its language's pairs, and its top terms."""
    row = shard.iloc[0]
    lang, terms, kept = row["lang"], list(row["terms"]), int(row["kept"])
    sources = list(row["sources"])
    totals = [int(n) for n in row["totals"]]
    place = {source: i for i, source in enumerate(sources)}
    matrix = np.zeros((len(sources), len(terms)), np.int64)
    for source, data in zip(counts["source"], counts["slots"]):
        add_packed(matrix[place[source]], data)
    whole = probabilities(matrix.sum(axis=0), sum(totals), kept)
    p = np.stack([probabilities(matrix[i], totals[i], kept) for i in range(len(sources))])
    frames = []
    for i, source in enumerate(sources):
        values = divergences(p[i], p).sum(axis=1)
        frames.append(
            pd.DataFrame({"source": source, "part": "pair", "item": [s.encode() for s in sources], "value": values})
            .drop(index=i)
        )
        stands_out = np.flatnonzero((matrix[i] > 0) & (p[i] > whole))
        values = divergences(p[i][stands_out], whole[stands_out])
        best = sorted(zip((-values).tolist(), (terms[k] for k in stands_out)))[:TOP]
        frames.append(
            pd.DataFrame(
                {
                    "source": source,
                    "part": "term",
                    "item": [term for _, term in best],
                    "value": [-value for value, _ in best],
                }
            )
        )
    out = pd.concat(frames, ignore_index=True)
    out.insert(0, "lang", lang)
    return out.astype({"value": "int64"})


def _vocabulary(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Kept terms in shards, one row for each shard, with its perfect hash."""
    kept = (
        docs.mapInPandas(_holding, "lang string, term binary, n bigint")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= FEW)
        .select("lang", "term")
    )
    kept = keep(kept, "kept-terms")
    keys = F.least(F.lit(SHARD_KEYS), F.greatest(F.lit(LEAST_KEYS), F.floor(CELLS / F.col("n_sources"))))
    hashed = F.xxhash64("term")
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt")
    langs = (
        kept.groupBy("lang")
        .agg(F.count(F.lit(1)).alias("kept"))
        .join(groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources")), "lang")
        .select("lang", F.ceil(F.col("kept") / keys).alias("shards"), salts)
    )
    # One language may hold most terms: they meet its number of shards in many tasks.
    salted = kept.withColumn("salt", F.pmod(hashed, F.lit(_SALTS)).cast("int"))
    dealt = salted.join(langs, ["lang", "salt"]).withColumn("shard", F.pmod(hashed, F.col("shards")))
    schema = (
        "lang string, shard bigint, shards bigint, n bigint, seed bigint, sizes binary, words binary, "
        "lengths binary, keys binary, terms array<binary>"
    )
    return keep(dealt.groupBy("lang", "shard").applyInPandas(_built, schema), "term-shards")


def _waves(vocabulary: DataFrame) -> tuple[DataFrame, int]:
    """Deal the shards to waves of a size that may be broadcast."""
    total = vocabulary.agg(F.sum("n")).first()[0] or 0
    waves = math.ceil(total / WAVE)
    while waves:
        dealt = vocabulary.withColumn("wave", F.pmod(F.xxhash64("lang", "shard"), F.lit(waves)))
        if dealt.groupBy("wave").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] <= 1.25 * WAVE:
            return dealt, waves
        waves += 1 + waves // 4
    return vocabulary.withColumn("wave", F.lit(0)), 0


def _counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Slots of each (lang, source, shard), in parts by task."""
    spark = docs.sparkSession
    counted, tasks = spark.createDataFrame([], _PART), 0
    dealt, waves = _waves(vocabulary)
    compact = dealt.drop("terms")
    for wave in range(waves):
        rows = compact.filter(F.col("wave") == wave).drop("wave").collect()
        sent = spark.sparkContext.broadcast((uuid.uuid4().hex, [r.asDict() for r in rows]))
        part = keep(docs.mapInPandas(_recounted(sent), _PART), "term-counts")
        sent.unpersist()
        counted = counted.unionByName(part)
        tasks = max(tasks, 1 + (part.agg(F.max("part")).first()[0] or 0))
    while tasks > FAN:
        counted = counted.withColumn("part", F.floor(F.col("part") / FAN))
        counted = counted.groupBy("lang", "source", "shard", "part").applyInPandas(_merged, _PART)
        tasks = math.ceil(tasks / FAN)
    return counted


def audit(docs: DataFrame) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank within source and part."""
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    groups = keep(docs.select("lang", "source").distinct(), "groups")
    vocabulary = _vocabulary(docs, groups)
    counted = _counts(docs, vocabulary)
    totals = counted.groupBy("lang", "source").agg(F.sum("total").alias("total"))
    langs = (
        groups.join(totals, ["lang", "source"], "left")
        .groupBy("lang")
        .agg(F.array_sort(F.collect_list(F.struct("source", F.coalesce("total", F.lit(0)).alias("total")))).alias("all"))
        .select("lang", F.col("all.source").alias("sources"), F.col("all.total").alias("totals"))
    )
    kept = vocabulary.groupBy("lang").agg(F.sum("n").alias("kept"), F.max("shard").alias("last"))
    run = F.explode(F.sequence(F.lit(0), F.floor(F.col("last") / _RUN).cast("int"))).alias("run")
    langs = langs.join(kept, "lang").select("lang", "sources", "totals", "kept", run)
    numbered = vocabulary.select("lang", "shard", "terms", F.floor(F.col("shard") / _RUN).cast("int").alias("run"))
    shards = numbered.join(langs, ["lang", "run"])
    partial = (
        counted.select("lang", "shard", "source", "slots")
        .groupBy("lang", "shard")
        .cogroup(shards.groupBy("lang", "shard"))
        .applyInPandas(_compared, "lang string, source string, part string, item binary, value bigint")
        .withColumn("item", F.col("item").cast("string"))
    )
    partial = keep(partial, "divergences")
    keys = ["lang", "source", "part"]
    pairs = partial.filter("part = 'pair'").groupBy(*keys, "item").agg(F.sum("value").alias("value"))
    bare = groups.join(kept, "lang", "left_anti")
    same = bare.join(bare.select("lang", F.col("source").alias("item")), "lang").filter("source != item")
    pairs = pairs.unionByName(same.select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("bigint").alias("value")))
    order = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("value"), "item"))
    pairs = pairs.withColumn("rank", order)
    terms = partial.filter("part = 'term'").withColumn("rank", order).filter(F.col("rank") <= TOP)
    return pairs.unionByName(terms).select(*keys, "item", "value", "rank")
