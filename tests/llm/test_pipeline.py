"""Every stage of the pipeline on its own input, and the whole run."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_corpus_operators import brute_components, edited
from test_text_operators import clean_line

STAGES = dict(corpus_pipeline.STAGES)
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _row int, _judged string, _lost int"


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A folder with labels, and documents with copies, boilerplate, odd rows and clashing column names."""
    rng = random.Random(4)
    rows = [(n, "\n".join(clean_line(10 * n + k) for k in range(4)) + f"\nAll rights belong to page {n}", "aa", f"s{n % 4}") for n in range(40)]
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    rows += [(100 + n, " ".join(edited(base, rng, n % 3)), "bb", "s1") for n in range(12)]
    rows += [(200, rows[3][1], "aa", None), (201, None, "aa", "s1"), (202, "", None, "s2"), (203, "123 456", "aa", "s2"), (None, clean_line(5555), None, "s3"), rows[7]]
    folder = str(tmp_path_factory.mktemp("small"))
    docs = spark.createDataFrame([(*r, len(r[1] or ""), 1, "x", 2) for r in rows], COLUMNS)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(n, n % 2, 0) for n in range(0, 40, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    schema = docs.schema
    judged = STAGES["language_id"](spark, docs, small)
    assert judged.schema == schema
    gone = {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in judged.collect()}
    assert gone == {201, 202, 203} and judged.count() == docs.count() - 3

    cleaned = STAGES["line_dedup"](spark, judged, small)
    assert cleaned.schema == schema and cleaned.count() == judged.count()
    texts = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert not any("rights belong" in t for t in texts.values())
    assert all(texts[n] == "\n".join(clean_line(10 * n + k) for k in range(4)) for n in range(40))

    apart = STAGES["minhash_near_dedup"](spark, cleaned, small)
    assert apart.schema == schema
    rows = [(r["doc_id"], r["text"]) for r in cleaned.collect()]
    wanted = sorted((d, c) for d, _, c in brute_components(rows, 5, 80) if d is not None and d == c)
    assert sorted(r["doc_id"] for r in apart.collect() if r["doc_id"] is not None) == [d for d, _ in wanted]
    kept = {r["doc_id"] for r in apart.collect()}
    assert None in kept and set(range(40)) <= kept and 200 not in kept

    mixed = STAGES["source_mixing"](spark, apart, small)
    assert mixed.schema == schema
    assert all(r["count"] <= 6 for r in mixed.groupBy("doc_id").count().collect())  # three times, and one id is there twice
    words = {r[0]: r[1] for r in apart.groupBy("source").agg(F.sum(F.size(F.split("text", r"\s+")))).collect()}
    taken = {r[0]: r[1] for r in mixed.groupBy("source").agg(F.sum(F.size(F.split("text", r"\s+")))).collect()}
    assert all(taken[s] <= 3 * words[s] for s in taken)

    packed = STAGES["best_fit_packing"](spark, mixed, small)
    assert packed.select("doc_id", "piece").where("piece = 0").count() == mixed.count()


def test_run_and_empty_tables(spark, small, tmp_path):
    first = corpus_pipeline.run(spark, small)
    assert first.count() > 0 and corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, small).count() == 0, name
