"""The corpus pipeline: stages in order, each on what the one before kept."""

import corpus_pipeline
from roost.llm.queries import QUERIES

TINY = "/root/testdata/sf0.001"


def test_stages_and_run(spark, tmp_path):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        columns = docs.columns
        stage(spark, docs, TINY).write.parquet(path)
        docs = spark.read.parquet(path)
        counts.append(docs.count())
        if name != "pack":
            assert docs.columns == columns
    assert counts[0] > counts[1] > counts[2] == counts[3]
    found = corpus_pipeline.run(spark, TINY)
    assert sorted(found.drop("sequence_id").collect()) == sorted(docs.drop("sequence_id").collect())


AWKWARD = "doc_id bigint, text string, lang string, source string, n_chars bigint, words int, row string, body string"


def awkward_rows():
    """Nulls everywhere, empty and very long texts, ties, repeated rows, clashing columns."""
    plain = "A plain line of a dozen different words that no rule has a reason to drop."
    long = " ".join(f"token{i}" for i in range(30_000))
    texts = [None, "", " \n ", "short", plain, plain, f"{plain} Mail jo@mail.example.com now.", long, long + " end", "x" * 100_000]
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), 1, "r", "b") for i, t in enumerate(texts)]
    rows += [rows[4], (None, plain + " Other.", None, None, None, None, None, None), (None,) * 8]
    return rows


def test_awkward_and_empty_tables_go_through(spark, tmp_path):
    for name, rows in (("awkward", awkward_rows()), ("empty", [])):
        folder = tmp_path / name
        spark.createDataFrame(rows, AWKWARD).write.parquet(f"{folder}/documents.parquet")
        packed = corpus_pipeline.run(spark, str(folder))
        found = packed.collect()
        if not rows:
            assert found == []
            continue
        # 5 is a copy of 4, 6 and 8 nearly are of 4 and 7; texts without ten words never pass;
        # the mix may leave out 4, some words beside the 30,000 of its source
        ids = {r.doc_id for r in found}
        assert {7, None} <= ids <= {4, 7, None}
        for r in found:
            assert 0 < r.length <= 2048 and r.offset + r.length <= 2048


def test_every_operator_is_registered():
    import __spark_entry__

    names = {f"op{n}_" for n in range(1, 14)}
    assert {name[: name.index("_") + 1] for name in QUERIES} == names
    assert {*QUERIES, "pipeline"} <= __spark_entry__.queries().keys()
