"""Near copies: an exact Jaccard join of shingle sets through a token-group matrix.

A document's set is its distinct shingles of ``SHINGLE`` words. Two documents link when
the sets share at least ``PERCENT`` percent of their union.

1. Documents with equal sets are one *class*; from here on, one document stands for it.
2. Tokens (shingles) are ordered rare first. Linked sets x and y share at least
   ``min(l(x), l(y))`` tokens among the first ``n - ceil(0.8 n) + l`` of each, where ``l``
   is a twentieth of the size. Only these leading tokens are shuffled, and only tokens
   found twice are kept. A document with too few of them is linked with nothing.
3. Similar documents are partitioned: each has ``SIGNS`` least hashes, and goes with those
   that share the one most common among all. Parts are of bounded size. Inside a part all
   links are found; documents linked there are one *cluster*.
4. The groups of the token-group matrix are the large clusters, and of each part the rest.
   It holds the leading tokens of each group, in blocks of ``BLOCK`` tokens. A document
   asks a block of another group, the smaller group the larger, only if enough of its
   leading tokens are there; there, its overlap with the union of the whole sets is
   counted, and only if that reaches 80 percent of its size are members opened.
5. Components of the clusters give the component of each document.

Every bound is one that linked documents must meet, so no link is lost. Links inside a
group need no pair of rows. Tokens are 64-bit hashes of the words.

Nulls and texts without words have empty sets, link with nothing and are their own
component. Repeated rows are equal sets. Rows repeating an id are placed each by its own
text. A null id never stands for others; alone, its component is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roost.llm.components import components
from roost.llm.store import keep
from roost.llm.words import mix, shingle_set

PERCENT = 80
BLOCK = 150_000  # tokens of the documents that are compared with each other in one group
SIGNS = 4
LARGE = 16  # documents of a cluster that is a group of its own
FREQUENT = 65_536  # tokens whose frequency decides their order; others count as rare
_CHUNK = 1_000_000  # tokens counted at a time
_SENT = 250_000  # tokens after which a task hands over its rows
_MEMBER, _QUERY = 0, 1
_SEEDS = mix(np.arange(1, SIGNS + 1, dtype=np.uint64))
_SEEN = 4  # times a token is found in a chunk before it is reported


def _ceil_share(n):
    """The least number of tokens that a set of n shares with one it links with."""
    return (n * PERCENT + 99) // 100


def _lead(n):
    return (n + 19) // 20


def _needed(n: Column) -> Column:
    """Leading tokens that a linked set has in common with its partner, at least."""
    return F.ceil(F.ceil(n * F.lit(PERCENT) / 100) / 20)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _first_pass(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each document with the key of its set; rows of tokens seen often."""
    pending, size = [], 0
    columns = ["doc_id", "n", "k1", "k2", "token", "seen"]

    def often() -> pd.DataFrame:
        tokens, counts = np.unique(np.concatenate(pending), return_counts=True)
        found = counts >= _SEEN
        rows = pd.DataFrame({"token": _signed(tokens[found]), "seen": counts[found]})
        return rows.reindex(columns=columns).astype({c: "Int64" for c in columns})

    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            tokens = shingle_set(text)
            pending.append(tokens)
            size += len(tokens)
            k1 = int(_signed(mix(tokens).sum(dtype=np.uint64, keepdims=True))[0])
            k2 = int(_signed(mix(tokens ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64, keepdims=True))[0])
            rows.append((doc_id, len(tokens), k1, k2, None, None))
            if size >= _CHUNK:
                yield often()
                pending, size = [], 0
        yield pd.DataFrame(rows, columns=columns).astype({c: "Int64" for c in columns})
    if pending:
        yield often()


def _leading(frequent: np.ndarray, counts: np.ndarray):
    """Second pass: the leading tokens of each document, rare first, and its signs."""

    def framed(rows: list) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=["doc_id", "n", "k1", "k2", "signs", "leading"])
        return frame.astype({"doc_id": "Int64"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, size = [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                tokens = shingle_set(text)
                n = len(tokens)
                if not n:
                    continue
                if size >= _SENT:
                    yield framed(rows)
                    rows, size = [], 0
                seen = np.zeros(n, np.int64)
                if len(frequent):
                    at = np.searchsorted(frequent, tokens).clip(max=len(frequent) - 1)
                    seen = np.where(frequent[at] == tokens, counts[at], 0)
                mixed = mix(tokens)
                other = mix(tokens ^ np.uint64(0xA0761D6478BD642F))
                first = np.lexsort((mixed, seen))[: n - _ceil_share(n) + _lead(n)]
                rows.append(
                    (
                        doc_id,
                        n,
                        int(_signed(mixed.sum(dtype=np.uint64, keepdims=True))[0]),
                        int(_signed(other.sum(dtype=np.uint64, keepdims=True))[0]),
                        [int(_signed(mix(tokens ^ seed).min(keepdims=True))[0]) for seed in _SEEDS],
                        _signed(tokens[first]),
                    )
                )
                size += len(first)
            yield framed(rows)

    return run


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows, size = [], 0
        for node, text in zip(batch["node"], batch["text"]):
            tokens = shingle_set(text)
            rows.append((node, len(tokens), tokens.tobytes()))
            size += len(tokens)
            if size >= _SENT:
                yield pd.DataFrame(rows, columns=["node", "n", "tokens"])
                rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=["node", "n", "tokens"])


class _Block:
    """The sets of a block's members, indexed by token."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        tokens = np.concatenate(sets)
        owners = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        self.tokens, self.owners = tokens[order], owners[order]

    def linked(self, tokens: np.ndarray) -> np.ndarray:
        """Members that the set links with. Opened only if the union overlaps enough."""
        low = np.searchsorted(self.tokens, tokens, "left")
        counts = np.searchsorted(self.tokens, tokens, "right") - low
        if np.count_nonzero(counts) < _ceil_share(len(tokens)):
            return np.empty(0, np.int64)
        low, counts = low[counts > 0], counts[counts > 0]
        starts = np.cumsum(counts) - counts
        at = np.arange(counts.sum()) + np.repeat(low - starts, counts)
        shared = np.bincount(self.owners[at], minlength=len(self.sizes))
        return np.flatnonzero(100 * shared >= PERCENT * (self.sizes + len(tokens) - shared))


def _runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Consecutive rows with equal keys, across batches."""
    rest = None
    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if not len(rows):
            continue
        values = rows[keys].to_numpy()
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        starts = [0, *cuts]
        for start, end in zip(starts, cuts):
            yield rows.iloc[start:end]
        rest = rows.iloc[starts[-1] :]
    if rest is not None and len(rest):
        yield rest


def _link_inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The least node linked to each node, links of the whole part followed."""
    for rows in _runs(batches, ["sign", "part"]):
        nodes = rows["node"].to_numpy()
        sets = [np.frombuffer(t, np.uint64) for t in rows["tokens"]]
        block, root = _Block(sets), np.arange(len(nodes))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i, tokens in enumerate(sets):
            for j in block.linked(tokens):
                if j > i:
                    a, b = find(i), find(j)
                    if a != b:
                        if nodes[a] < nodes[b]:
                            root[b] = a
                        else:
                            root[a] = b
        yield pd.DataFrame(
            {
                "sign": rows["sign"].to_numpy(),
                "part": rows["part"].to_numpy(),
                "node": nodes,
                "cluster": [nodes[find(i)] for i in range(len(nodes))],
            }
        )


def _open_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links between clusters: rows of a block are its members, then its queries."""
    for rows in _runs(batches, ["mixed", "unit", "block", "salt"]):
        sets = [np.frombuffer(t, np.uint64) for t in rows["tokens"]]
        clusters = rows["cluster"].to_numpy()
        members = np.count_nonzero(rows["role"] == _MEMBER)
        if not members or members == len(sets):
            continue
        block, found = _Block(sets[:members]), set()
        for own, tokens in zip(clusters[members:], sets[members:]):
            found.update((own, other) for other in np.unique(clusters[block.linked(tokens)]))
        if found:
            yield pd.DataFrame(sorted(found), columns=["a", "b"])


def _parts(total: Column) -> Column:
    return F.greatest(F.ceil(total / F.lit(BLOCK)), F.lit(1)).cast("bigint")


def _salt(node: Column, parts: Column) -> Column:
    return F.pmod(F.xxhash64(node), parts)


def _between(shared: DataFrame, sets: DataFrame, placed: DataFrame) -> DataFrame:
    """Edges (a, b) between clusters that hold a linked pair.

    ``placed`` has node, n, cluster, and sign and part where similar documents were found.
    """
    many = placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("many"))
    mixed = (F.col("many") < LARGE) & F.col("part").isNotNull()
    placed = placed.join(many, "cluster").select(
        "node",
        "n",
        "cluster",
        mixed.cast("int").alias("mixed"),
        F.when(mixed, F.xxhash64("sign", "part")).otherwise(F.col("cluster")).alias("unit"),
    )
    sizes = placed.groupBy("mixed", "unit").agg(F.sum("n").alias("unit_n"))
    placed = placed.join(sizes, ["mixed", "unit"])
    placed = placed.withColumn("block", _salt(F.col("node"), _parts(F.col("unit_n"))))
    placed = keep(placed.withColumn("rank", F.struct("unit_n", "mixed", "unit")), "placed")
    token = Window.partitionBy("token")
    rows = (
        shared.join(placed, "node")
        .withColumn("top", F.max("rank").over(token))
        .withColumn("low", F.min("rank").over(token))
        .filter("low <> top")
        .drop("low")
    )
    rows = keep(rows.select("token", "node", "n", "cluster", "rank", "top", "block"), "matrix")
    # The smaller of two groups asks the larger one.
    queries = rows.filter("rank <> top").select("token", "node", "n", "cluster", F.col("rank").alias("own"))
    matrix = rows.groupBy("token", "rank", "block").agg(F.min("n").alias("least_n"), F.max("n").alias("most_n"))
    pairs = (
        queries.join(matrix, "token")
        .filter((F.col("own") < F.col("rank")) & (F.col("most_n") * 100 >= F.col("n") * PERCENT))
        .filter(F.col("least_n") * PERCENT <= F.col("n") * 100)
        .groupBy("node", "n", "cluster", "rank", "block")
        .agg(F.count(F.lit(1)).alias("common"))
        .filter(F.col("common") >= _needed(F.col("n")))
        .select("node", "n", "cluster", "rank.mixed", "rank.unit", "block")
    )
    pairs = keep(pairs, "pairs")
    where = ["mixed", "unit", "block"]
    asked = keep(pairs.groupBy(*where).agg(_parts(F.sum("n")).alias("parts")), "asked")
    asking = (
        pairs.join(asked, where)
        .withColumn("salt", _salt(F.col("node"), F.col("parts")))
        .join(sets.select("node", "tokens"), "node")
        .select(*where, "salt", F.lit(_QUERY).alias("role"), "cluster", "tokens")
    )
    members = (
        placed.select("node", "cluster", *where)
        .join(asked, where)
        .join(sets.select("node", "tokens"), "node")
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
        .select(*where, "salt", F.lit(_MEMBER).alias("role"), "cluster", "tokens")
    )
    return (
        members.unionByName(asking)
        .repartition(*where, "salt")
        .sortWithinPartitions(*where, "salt", "role")
        .mapInPandas(_open_groups, "a bigint, b bigint")
    )


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for each row."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    first = keep(
        docs.mapInPandas(
            _first_pass, "doc_id bigint, n bigint, k1 bigint, k2 bigint, token bigint, seen bigint"
        ),
        "first-pass",
    )
    keyed = first.filter("k1 is not null").select("doc_id", "n", "k1", "k2")
    top = (
        first.filter("token is not null")
        .groupBy("token")
        .agg(F.sum("seen").alias("seen"))
        .orderBy(F.desc("seen"), "token")
        .limit(FREQUENT)
        .toPandas()
    )
    frequent = top["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(frequent)
    leading = _leading(frequent[order], top["seen"].to_numpy(np.int64)[order])

    classes = (
        docs.mapInPandas(
            leading, "doc_id bigint, n bigint, k1 bigint, k2 bigint, signs array<bigint>, leading array<bigint>"
        )
        .groupBy("k1", "k2")
        .agg(
            F.min("doc_id").alias("node"),
            F.first("n").alias("n"),
            F.first("signs").alias("signs"),
            F.first("leading").alias("leading"),
        )
    )
    classes = keep(classes, "classes")
    tokens = classes.filter("node is not null").select("node", "n", F.explode("leading").alias("token"))
    twice = F.count(F.lit(1)).over(Window.partitionBy("token")) > 1
    shared = tokens.withColumn("twice", twice).filter("twice").drop("twice")
    shared = keep(shared, "shared")
    active = shared.groupBy("node").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("common"))
    active = active.filter(F.col("common") >= _needed(F.col("n"))).select("node")
    shared = shared.select("node", "token")

    sets = docs.join(active, docs["doc_id"] == active["node"]).select("node", "text")
    sets = keep(sets.mapInPandas(_sets, "node bigint, n bigint, tokens binary"), "sets")
    signs = sets.select("node", "n").join(classes.select("node", "signs"), "node")
    signs = signs.select("node", "n", F.posexplode("signs").alias("k", "value"))
    common = signs.groupBy("k", "value").agg(F.count(F.lit(1)).alias("many")).filter("many > 1")
    best = signs.join(common, ["k", "value"]).groupBy("node").agg(
        F.max("n").alias("n"), F.max(F.struct("many", "k", "value")).alias("best")
    )
    best = keep(best.select("node", "n", F.xxhash64("best.k", "best.value").alias("sign")), "signs")
    parts = best.groupBy("sign").agg(F.count(F.lit(1)).alias("many"), _parts(F.sum("n")).alias("parts"))
    similar = best.join(parts.filter("many > 1"), "sign").select(
        "node", "sign", _salt(F.col("node"), F.col("parts")).alias("part")
    )
    inside = keep(
        sets.join(similar, "node")
        .select("sign", "part", "node", "tokens")
        .repartition("sign", "part")
        .sortWithinPartitions("sign", "part")
        .mapInPandas(_link_inside, "sign bigint, part bigint, node bigint, cluster bigint"),
        "inside",
    )
    inside = inside.groupBy("node").agg(
        F.min("cluster").alias("cluster"), F.max("sign").alias("sign"), F.max("part").alias("part")
    )
    placed = sets.groupBy("node").agg(F.max("n").alias("n")).join(inside, "node", "left")
    placed = placed.select("node", "n", F.coalesce("cluster", "node").alias("cluster"), "sign", "part")
    placed = keep(placed, "clusters")

    roots = components(_between(shared, sets, placed))
    found = (
        placed.join(roots.withColumnRenamed("id", "cluster"), "cluster", "left")
        .select("node", F.coalesce("root", "cluster").alias("root"))
        .filter("root < node")
    )
    named = classes.select("k1", "k2", "node").join(found, "node", "left")
    named = named.select("k1", "k2", F.coalesce("root", "node").alias("component"))
    return keyed.join(named, ["k1", "k2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
    )


def first_of_each_group(docs: DataFrame) -> DataFrame:
    """The document with the least id of each component, one row of it; columns as given.

    Of rows that repeat an id, the one with the greatest text stays. Rows without an id
    stay: nothing tells them apart from each other.
    """
    kept = near_copies(docs).filter("doc_id = component_id").select("doc_id").distinct()
    row = docs.select(F.col("doc_id").cast("bigint").alias("key"), F.struct("*").alias("row"))
    repeated = (
        docs.groupBy(F.col("doc_id").cast("bigint").alias("key")).count().filter("count > 1").select("key")
    )
    once = row.join(kept, row["key"] == kept["doc_id"], "left_semi").join(repeated, "key", "left_anti")
    best = Window.partitionBy("key").orderBy(F.col("row.text").desc_nulls_last())
    many = (
        row.join(kept, row["key"] == kept["doc_id"], "left_semi")
        .join(repeated, "key", "left_semi")
        .withColumn("at", F.row_number().over(best))
        .filter("at = 1")
        .drop("at")
    )
    return once.unionByName(many).unionByName(row.filter("key is null")).select("row.*")
