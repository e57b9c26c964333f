"""The pipeline's stages in order, and the registered queries."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline

DIRECTORY = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_operator_is_registered():
    names = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert names == {f"op{i}" for i in range(1, 14)} and "pipeline" in entry.queries()


def test_stages(spark):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet").cache()
    more = spark.createDataFrame([(90001, "123 456 --", "en", "x", 10), (90002, None, "en", "x", None),
                                  (90003, "Mail ada@example.org or call, thanks. Andthe thonre is was in the.", "en", "x", 1)], docs.schema)
    first = docs.first()
    copies = docs.where(F.col("doc_id") == first.doc_id).withColumn("doc_id", F.lit(90004).cast("long"))
    rows = docs.unionByName(more).unionByName(copies)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, DIRECTORY).cache()
        seen[name] = rows
        if name != "packing":
            assert rows.columns == COLUMNS and rows.schema == docs.schema
    ids = {name: {r[0] for r in df.select("doc_id").collect()} for name, df in seen.items()}
    assert {90001, 90002}.isdisjoint(ids["language"]) and 90003 in ids["language"]
    assert len(ids["language"]) == docs.count() + 2
    assert ids["line_dedup"] == ids["language"]
    text = {r.doc_id: r.text for r in seen["line_dedup"].collect()}
    assert text[90004] == ""
    assert ids["near_duplicates"] <= ids["line_dedup"] and ids["personal_data"] == ids["near_duplicates"] == ids["packing"]
    assert "<email>" in {r.doc_id: r.text for r in seen["personal_data"].collect()}[90003]
    packed = seen["packing"].groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("t"))
    assert packed.where("n != t").count() == 0


def test_near_duplicates_leave_the_smallest_id(spark):
    base = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(3, base, "en", "s", 1), (1, base + " end", "en", "s", 1), (2, "quite another text with words", "en", "s", 1),
                                  (4, "", "en", "s", 0), (5, None, "en", "s", 0), (None, base, "en", "s", 0)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, DIRECTORY)
    assert sorted(str(r.doc_id) for r in got.collect()) == ["1", "2", "4", "5"]


@pytest.mark.parametrize("parts", [1, 3])
def test_near_duplicates_decide_each_row_by_its_text(spark, parts):
    base, clean = " ".join(f"w{i}" for i in range(80)), " ".join(f"other{i}" for i in range(60))
    rows = [(5, clean), (5, base), (3, base + " end"), (8, "two rows of one id and one text"), (8, "two rows of one id and one text"),
            (9, ""), (9, ""), (None, "no id here but words enough"), (None, "no id here but words enough"), (None, clean + " more"), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "x") for i, t in rows],
                                 "doc_id long, text string, lang string, class string, n_chars long, id string").repartition(parts)
    got = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, DIRECTORY)
    assert got.schema == docs.schema
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        [(5, clean), (3, base + " end"), (8, "two rows of one id and one text"), (9, ""), (9, ""),
         (None, "no id here but words enough"), (None, None)], key=str)
    assert corpus_pipeline.keep_one_of_near_duplicates(spark, docs.limit(0), DIRECTORY).count() == 0


def test_run_writes_into_the_shared_folder(spark):
    out = corpus_pipeline.run(spark, DIRECTORY)
    assert out.count() > 0 and {"doc_id", "start", "length", "sequence_id"} <= set(out.columns)
