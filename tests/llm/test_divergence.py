"""The source divergence audit against its SQL, and its perfect hashes against a dictionary."""

import random

import numpy as np
import pytest

from checks.compare import connect, difference
from roost.llm import divergence
from roost.llm.oracle import ORACLE
from roost.llm.perfect_hash import PerfectHash, Shard, hashes, shard_of, stored
from roost.llm.queries import QUERIES
from tests.conftest import SMALL

SQL = ORACLE["op11_source_divergence"]
SCHEMA = "doc_id bigint, text string, lang string, source string, term string, slots string, part int"


def word(rng):
    return "".join(rng.choice("abcdeÄéß漢") for _ in range(rng.randrange(1, 4)))


@pytest.fixture(scope="module")
def awkward(spark):
    rng = random.Random(4)
    rows = []
    for i in range(240):
        text = " ".join(word(rng) for _ in range(rng.randrange(60)))
        lang = rng.choice([None, "", "en", "EN", "de\0x"])
        rows.append((i, text, lang, rng.choice([None, "", "a", "b", "ü"]), "x", "y", 1))
    rows += [(1000 + i, f"{'Long' * 20}{'é' * i} {'q' * 40000} B-2B,b'b_B b", "en", "a", None, None, 2) for i in range(5)]
    rows += [rows[5]] * 7 + [(None, None, None, None, None, None, None), (None, "a B", None, "only", None, None, None)]
    rows += [(2000 + i, f"rare{chr(97 + i)}", "xx", f"s{i}", None, None, 3) for i in range(4)]
    rows += [(2010, None, "yy", "s", None, None, 3), (2011, "...", "yy", None, None, None, 3)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def check(spark, docs):
    sql = connect(SMALL)
    sql.execute("DROP VIEW documents")
    sql.register("documents", docs.toPandas())
    return difference(divergence.audit(docs), sql, SQL)


def test_the_query_matches_sql(spark):
    assert difference(QUERIES["op11_source_divergence"](spark, SMALL), connect(SMALL), SQL) is None


def test_awkward_rows_match_sql(spark, awkward):
    assert check(spark, awkward) is None


def test_several_waves_and_steps_give_the_same(spark, awkward, monkeypatch):
    monkeypatch.setattr(divergence, "WAVE", 100)
    monkeypatch.setattr(divergence, "SHARD_KEYS", 16)
    monkeypatch.setattr(divergence, "LEAST_KEYS", 4)
    monkeypatch.setattr(divergence, "FAN", 2)
    assert check(spark, awkward) is None


def test_an_empty_table_gives_no_rows(spark):
    found = divergence.audit(spark.createDataFrame([], SCHEMA))
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"] and found.count() == 0


def test_probabilities_are_exact_far_beyond_a_bigint_product():
    counts, total, kept = np.array([0, 1, 10**12, 4 * 10**15]), 4 * 10**15, 10**9
    exact = [1 + divergence.SCALE * (int(c) + 1) // (total + kept) for c in counts]
    assert divergence.probabilities(counts, total, kept).tolist() == exact


@pytest.mark.parametrize("size", [0, 1, 2, 500])
def test_perfect_hash_is_minimal_and_checks_keys(size):
    rng = random.Random(size)
    terms = list({"".join(rng.choices("abcdef", k=rng.choice([3, 9, 50]))).encode() for _ in range(size)})
    shards, dealt = 3, [[], [], []]
    for term, shard in zip(terms, shard_of(hashes(terms), 3).tolist()):
        dealt[shard].append(term)
    parts, keys = [], []
    for of_shard in dealt:
        shard = Shard.build(of_shard)
        slots = shard.slots(of_shard).tolist()
        assert sorted(slots) == list(range(len(of_shard)))
        keys.append([stored(term) for _, term in sorted(zip(slots, of_shard))])
        parts.append(shard)
    table = PerfectHash(parts, range(shards), shards, keys)
    assert sorted(table.slots(terms).tolist()) == list(range(len(terms)))
    assert (table.slots([t + b"x" for t in terms] + [b"g"]) == -1).all()
    some = PerfectHash(parts[1:2], [1], shards, keys[1:2])
    assert sorted(s for s in some.slots(terms).tolist() if s >= 0) == list(range(len(dealt[1])))


def test_equal_hashes_get_another_seed(monkeypatch):
    from roost.llm import perfect_hash

    true = perfect_hash.hashes
    monkeypatch.setattr(
        perfect_hash, "hashes", lambda terms, seed=42: true(terms, seed) if seed > 42 else np.zeros(len(terms), np.uint64)
    )
    terms = [b"one", b"two", b"three"]
    shard = Shard.build(terms)
    assert shard.seed == 43 and sorted(shard.slots(terms).tolist()) == [0, 1, 2]
