"""Mixing sources to target weights along a time-varying curriculum.

A document's size is its number of words. Sources in code point order, null last, weigh
``WEIGHTS`` in turn. Targets share the total size by weight; a source stops at ``LIMIT``
times its own size, and the excess is shared again until none is above.

Each source's weight changes over the run: ``SHAPES`` gives it at evenly spaced times,
straight lines between, scaled so that its integral is the source's target. A source's
documents, in the order of a hash, are laid end to end as often as the target needs. A
pass of a document is taken if its middle lies before the target. Its place there is the
cumulative demand that must have arisen when it is used; inverting the integral of the
schedule gives the time, its training position in [0, 1]. One range sort of all passes by
position, then id, text and source, is the training order; a pass's place is its rank there.

Nothing is gathered: documents are cut into slices by that hash, so many that one holds
about ``PER_SLICE`` of them. Sums of slices give each slice's start, added up in blocks of
about as many slices as there are blocks, and only inside a slice are documents ordered. The
tables of sources have one row per source.

Null text has size 0, and so have texts without words; they take no position. Null is a
source of its own. The hash is of id and text, so rows that share an id, or have none, lie in
different slices; only equal rows share one, in any order among themselves.
Extra columns pass through ``mix_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roost.llm.store import keep
from roost.llm.words import word_count

WEIGHTS = (5, 2, 1)
LIMIT = 3
#: Weight over time, one shape for each of the weights; each has the mean 1.
SHAPES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))
PER_SLICE = 1 << 12  # documents
_HASH_BITS = 60  # fifteen hexadecimal digits


def _ranked(rows: DataFrame, purpose: str, *order: str | Column) -> DataFrame:
    """Add ``place``, counted from 0 in the given order.

    Rows are range-sorted; only the number of rows in each range meets in one task.
    """
    ordered = rows.orderBy(*order)
    ordered = keep(
        ordered.select("*", F.spark_partition_id().alias("part")).withColumn(
            "within", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
        ),
        purpose,
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ordered.groupBy("part")
        .agg(F.count(F.lit(1)).alias("many"))
        .select("part", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("start"))
    )
    return ordered.join(starts, "part").withColumn("place", F.col("start") + F.col("within"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """source, source_size, place, target of the rows (source, size)."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    kinds = F.array(*[F.lit(w).cast("bigint") for w in weights])
    table = _ranked(sources, "sources", F.col("source").asc_nulls_last()).select(
        "source",
        "source_size",
        "place",
        F.get(kinds, (F.col("place") % len(weights)).cast("int")).alias("weight"),
    )
    table = keep(table, "weights")
    # Raise the level until no source is above its limit; each round stops one more at least.
    level = None
    while True:
        stopped = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= limit * F.col("source_size")
        total, held, open_weight = table.agg(
            F.sum("source_size"),
            F.sum(F.when(stopped, limit * F.col("source_size")).otherwise(0)),
            F.sum(F.when(~stopped, F.col("weight")).otherwise(0)),
        ).first()
        if not open_weight or (level is not None and (total - held) / open_weight == level):
            break
        level = (total - held) / open_weight
    share = F.col("weight") * F.lit(float(level or 0.0))
    most = (limit * F.col("source_size")).cast("double")
    return table.withColumn("target", F.when(share >= most, most).otherwise(share))


def _time(share: Column, shape: Column) -> Column:
    """When the integral of ``shape``, scaled to 1, reaches ``share``."""
    found = F.lit(None).cast("double")
    knots = len(SHAPES[0]) - 1
    at = lambda k: F.get(shape, F.lit(k))
    area = lambda k: (at(k) + at(k + 1)) / 2
    whole = sum((area(k) for k in range(knots)), F.lit(0.0))
    done = F.lit(0.0)
    for k in range(knots):
        left = share * whole - done
        slope = at(k + 1) - at(k)
        root = F.sqrt(F.greatest(at(k) * at(k) + 2 * slope * left, F.lit(0.0)))
        inside = F.when(left <= 0, F.lit(0.0)).otherwise(2 * left / (at(k) + root))
        found = F.coalesce(
            found, F.when((left <= area(k)) | F.lit(k == knots - 1), (k + F.least(inside, F.lit(1.0))) / knots)
        )
        done = done + area(k)
    return found


def slice_bits(rows: int, per_slice: int) -> int:
    """Leading bits of the hash that name a slice."""
    return min(max(4, (rows // per_slice).bit_length()), _HASH_BITS)


def _starts(sums: DataFrame, keys: list[str], along: str, size: str, start: str) -> DataFrame:
    """Add ``start``: what lies before each row of ``keys`` in the order of ``along``."""
    before = Window.partitionBy(*keys).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn(start, F.coalesce(F.sum(size).over(before), F.lit(0)))


def _laid_out(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key columns, size, start in the source) of each row, and the targets."""
    bits = slice_bits(docs.count(), PER_SLICE)
    rows = docs.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        F.xxhash64("text").alias("text_key"),
    )
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_key").cast("string"))
    rows = rows.withColumn("order", F.md5(name.cast("binary")))
    leading = F.conv(F.substring("order", 1, _HASH_BITS // 4), 16, 10).cast("bigint")
    rows = rows.withColumn("slice", F.shiftright(leading, _HASH_BITS - bits))
    targets = keep(source_targets(rows), "targets")
    sums = rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    sums = keep(sums.withColumn("block", F.shiftright("slice", bits // 2)), "slices")
    blocks = _starts(
        sums.groupBy("source", "block").agg(F.sum("slice_size").alias("block_size")),
        ["source"], "block", "block_size", "block_start",
    )
    inside = _starts(sums, ["source", "block"], "slice", "slice_size", "in_block")
    same = inside["source"].eqNullSafe(blocks["source"]) & (inside["block"] == blocks["block"])
    slices = inside.join(blocks, same).select(
        inside["source"], "slice", (F.col("block_start") + F.col("in_block")).alias("slice_start")
    )
    ahead = (
        Window.partitionBy("source", "slice")
        .orderBy("order", "doc_id", "size", "text_key")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = rows.withColumn("ahead", F.coalesce(F.sum("size").over(ahead), F.lit(0)))
    same = rows["source"].eqNullSafe(slices["source"]) & (rows["slice"] == slices["slice"])
    rows = rows.join(slices, same).select(
        "doc_id",
        rows["source"],
        "size",
        "text_key",
        (F.col("slice_start") + F.col("ahead")).alias("start"),
    )
    return rows, targets


def _passes(start: Column, size: Column, source_size: Column, target: Column) -> Column:
    """Times that the document's middle is met while the source is laid out up to its target."""
    met = F.ceil((target - (start + size / 2)) / F.nullif(source_size, F.lit(0)))
    return F.when(size > 0, F.greatest(F.least(met, F.lit(LIMIT)), F.lit(0))).otherwise(0).cast("bigint")


def _mixed(docs: DataFrame) -> DataFrame:
    rows, targets = _laid_out(docs)
    rows = rows.join(targets, rows["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    return rows.withColumn(
        "passes", _passes(F.col("start"), F.col("size"), F.col("source_size"), F.col("target"))
    )


def _positions(passes: Column) -> Column:
    """Training positions of a document's passes."""
    shapes = F.array(*[F.array(*[F.lit(float(w)) for w in shape]) for shape in SHAPES])
    shape = F.get(shapes, (F.col("place") % len(SHAPES)).cast("int"))
    middle = lambda k: F.col("start") + F.col("size") / 2 + k * F.col("source_size")
    return F.transform(
        F.when(passes > 0, F.sequence(F.lit(0).cast("bigint"), passes - 1)).otherwise(
            F.array().cast("array<bigint>")
        ),
        lambda k: _time(F.least(middle(k) / F.col("target"), F.lit(1.0)), shape),
    )


def mixture(docs: DataFrame) -> DataFrame:
    """What the mix takes of each document, and the positions and places of its passes."""
    mixed = _mixed(docs).select(
        "doc_id",
        "source",
        "text_key",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("passes")).alias("taken"),
        _positions(F.col("passes")).alias("positions"),
        F.monotonically_increasing_id().alias("row"),
    )
    mixed = keep(mixed, "mixed")
    passes = mixed.select("row", "doc_id", "text_key", "source", F.explode("positions").alias("position"))
    order = _ranked(passes, "order", "position", "doc_id", "text_key", "source")
    places = order.groupBy("row").agg(F.sort_array(F.collect_list("place")).alias("places"))
    return mixed.join(places, "row", "left").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "taken",
        "positions",
        F.coalesce("places", F.array().cast("array<bigint>")).alias("places"),
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """Documents in training order, a row for each pass; columns as given."""
    places = _mixed(docs).filter("passes > 0").select(
        F.col("doc_id").alias("key"), F.col("text_key").alias("key2"), F.col("source").alias("key3"),
        _positions(F.col("passes")).alias("positions"),
    )
    # Equal rows are interchangeable: each number of a row meets the positions of one of them.
    twins = lambda *keys: Window.partitionBy(*keys).orderBy(*keys)
    places = places.withColumn("twin", F.row_number().over(twins("key", "key2", "key3")))
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").alias("id"),
        F.xxhash64("text").alias("id2"),
        F.col("source").alias("id3"),
    ).withColumn("nth", F.row_number().over(twins("id", "id2", "id3")))
    same = (
        F.col("id").eqNullSafe(F.col("key"))
        & (F.col("id2") == F.col("key2"))
        & F.col("id3").eqNullSafe(F.col("key3"))
        & (F.col("nth") == F.col("twin"))
    )
    taken = rows.join(places, same).select("row", "id", "id2", "id3", F.explode("positions").alias("position"))
    return taken.orderBy("position", "id", "id2", "id3").select("row.*")
