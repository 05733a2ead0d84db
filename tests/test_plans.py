"""What the physical plans must look like to hold at scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from corpusloom.operators import chunk, clean, govern, graph, search, stats
from corpusloom.sources import layout


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_and_filters_only_what_is_asked(spark, folder):
    text = plan(entry_points.queries()["parquet_scan_filter"](spark, folder))
    assert "EqualTo(lang,en)" in text and "GreaterThan(n_chars,50)" in text
    assert "text:string" not in text


def test_chunking_never_shuffles(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for strategy in chunk.STRATEGIES:
        text = plan(chunk.chunk_documents(docs, strategy, doc_id="doc_id", text="text", keep=("lang",)))
        assert "Exchange" not in text
        assert "n_chars" not in text
        assert text.count("ArrowEvalPython [") == (strategy in ("fixed", "sentence"))
        assert text.count("regexp_extract_all") == (strategy in ("grid", "window"))


def test_search_is_one_pass_with_a_bounded_result(spark, folder):
    corpus = spark.read.parquet(f"{folder}/embeddings.parquet")
    text = plan(search.search(corpus, [1.0] * 64, 10, chunk_id="vec_id"))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text and text.count("ArrowEvalPython [") == 1
    assert "label" not in text


def test_latest_row_is_combined_before_the_shuffle(spark, folder):
    text = plan(clean.dedup_latest(spark.read.parquet(f"{folder}/events.parquet"), "user_id", "ts", "event_id"))
    assert "partial_max_by" in text and text.count("Exchange") == 1 and "Window" not in text


def test_link_targets_are_grouped_before_they_meet_the_visited_set(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    visited = pages.select(F.col("url").alias("canonical"))
    text = plan(graph.frontier_step(pages, visited, strip_regions=False))
    assert text.index("LeftOuter") < text.index("partial_min")


def test_checksum_and_manifest_hash_each_text_once(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert plan(stats.content_checksum(docs, "text")).count("md5(cast(text") == 1
    manifest = plan(stats.grid_manifest(docs, "d", "v1", text="text"))
    assert manifest.count("FileScan") == 1 and manifest.count("md5(cast(_chunk") == 1


def test_scrubbing_replaces_once_per_kind(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    text = plan(govern.scrub_personal_data(docs, "text"))
    assert text.count("regexp_replace") == len(govern.PERSONAL)


@pytest.fixture
def built(spark, tmp_path):
    rows = spark.range(1000).select(F.format_string("r%04d", "id").alias("record_id"), F.lit("x").alias("license"))
    layout.write_version(rows, str(tmp_path), "attributions", "d", "v1", sort_by="record_id")
    layout.write_version(rows, str(tmp_path), "attributions", "e", "v1", sort_by="record_id")
    return str(tmp_path)


def test_lookup_is_pushed_to_sorted_files(spark, built):
    found = layout.read_version(spark, built, "attributions", "d").where("record_id = 'r0123'")
    assert "EqualTo(record_id,r0123)" in plan(found) and found.count() == 1


def test_versions_are_pruned(spark, built):
    one = layout.read_all_versions(spark, built, "attributions").where("dataset = 'e' AND version = 'v1'")
    assert "PartitionFilters: [isnotnull(dataset" in plan(one) and one.count() == 1000
