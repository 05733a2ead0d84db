"""Builds from pages, messages and items: odd rows, moderation, the sidecar."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import graph
from corpusloom.plans import build
from corpusloom.schemas import ITEMS
from corpusloom.sources import layout

PAGE = "url string, html string, status_code int, content_type string, crawled_at timestamp_ntz, id string"
LONG = "words that are long enough to stay in the version " * 2


def pages(spark, rows):
    days = F.to_timestamp_ntz("day")
    schema = PAGE.replace("crawled_at timestamp_ntz", "day string")
    return spark.createDataFrame(rows, schema).withColumn("crawled_at", days).drop("day")


def stored(spark, root, table="documents"):
    return layout.read_version(spark, root, table, "d", "v2025.1.1")


def test_pages_that_have_no_text_address_or_answer_stay_out(spark, tmp_path):
    rows = [
        ("https://a.org/1", f"<body>{LONG}</body>", 200, "text/html", "2025-01-02", "clash"),
        ("https://a.org/1", "<body>older</body>", 200, None, "2025-01-01", None),
        ("https://a.org/2", f"<body>{LONG}</body>", None, None, None, None),
        ("https://a.org/3", f"<body>{LONG}</body>", 404, None, "2025-01-02", None),
        ("https://a.org/4", "", 200, None, "2025-01-02", None), ("https://a.org/5", None, 200, None, "2025-01-02", None),
        (None, f"<body>{LONG}</body>", 200, None, "2025-01-02", None),
        ("https://a.org/6", "<body>" + "long text " * 50_000 + "</body>", 200, None, "2025-01-02", None),
    ]
    report = build.build_from_pages(pages(spark, rows), str(tmp_path), "d", "v2025.1.1").first()
    assert report.documents == 3
    found = {r.source_url: r for r in stored(spark, str(tmp_path)).collect()}
    assert sorted(found) == [f"https://a.org/{n}" for n in (1, 2, 6)]
    assert json.loads(found["https://a.org/1"].metadata) == {"status_code": 200, "content_type": "text/html"}
    assert len(found["https://a.org/6"].content) > 499_000
    assert stored(spark, str(tmp_path), "embeddings").count() == stored(spark, str(tmp_path), "chunks").count() > 600


@pytest.mark.parametrize("make", [build.build_from_pages, build.build_messages])
def test_no_pages(spark, tmp_path, make):
    assert make(pages(spark, []), str(tmp_path), "d", "v2025.1.1").first().documents == 0


def test_items(spark, tmp_path):
    def item(number, **values):
        return tuple({"id": number, **values}.get(f.name) for f in ITEMS)

    rows = [item(1, title="One", text="<p>two &amp;</p>", score=3), item(2, title="", text=None), item(3, text="x", url="u"), item(3, text="x", url="u")]
    items = spark.createDataFrame([*rows, item(4)], ITEMS)
    build.build_items(items, str(tmp_path), "d", "v2025.1.1", encoder=None)
    found = {r.id: r for r in stored(spark, str(tmp_path)).collect()}
    assert {k: (r.source_url, r.content.split("\n")[0]) for k, r in found.items()} == {"1": ("item:1", "One"), "3": ("u", "x")}
    assert json.loads(found["1"].metadata) == {"score": 3}


def documents(spark, rows):
    docs = spark.createDataFrame(rows, "id string, source_url string, title string, content string")
    return docs.select(
        "*", F.lit("{}").alias("metadata"), F.lit("MIT").alias("license"), F.lit("A").alias("author"), F.current_timestamp().alias("processed_at")
    )


def test_moderation_of_odd_lists(spark):
    docs = documents(spark, [("1", "a", "t", "mail me: x@y.org"), ("2", "b", None, ""), ("3", "c", None, None), ("4", "d", "q@y.org", "z")])
    unwanted = spark.createDataFrame([("2", 1), ("2", 1), (None, 1), ("9", 1)], "id string, content int")
    claimed = spark.createDataFrame([(None,), ("c",), ("c",)], "source_url string")
    left = build.Moderation(unwanted, claimed, scrub=True).apply(docs)
    assert left.columns == docs.columns
    assert sorted((r.id, r.title, r.content) for r in left.collect()) == [("1", "t", "mail me: [EMAIL]"), ("4", "[EMAIL]", "z")]
    assert build.Moderation().apply(docs).count() == 4
    assert build.Moderation(unwanted.limit(0), claimed.limit(0)).apply(docs).count() == 4


def test_sidecar_is_stored_with_a_version_and_deleted_with_it(spark, tmp_path):
    docs = documents(spark, [("1", "a", "t", LONG), ("2", "b", "t", LONG)])
    docs = docs.withColumn("license", F.when(F.col("id") == "1", "MIT").otherwise("Apache-2.0"))
    build.build_documents(docs, str(tmp_path), "d", "v2025.1.1", encoder=None, source="feed")
    row = layout.read_sidecar(spark, str(tmp_path), "d").first()
    assert (row.dataset_name, row.version, row.record_count, row.source, row.license) == ("d", "v2025.1.1", 2, "feed", "Apache-2.0/MIT")
    assert row.created_at is not None
    layout.delete_version(spark, str(tmp_path), "d", "v2025.1.1")
    assert not (tmp_path / "metadata" / "dataset=d" / "version=v2025.1.1").exists()


def test_walk_plan_does_not_grow_with_depth(spark):
    rows = [(f"https://s.org/{n}", f'<body><a href="/{n + 1}">x</a></body>') for n in range(12)]
    site = spark.createDataFrame([*rows, (None, None), ("https://s.org/0", None)], "url string, html string")
    walked = graph.crawl_order(site, ["https://s.org/0", None, "https://s.org/0"])
    assert [(r.canonical, r.depth) for r in walked.orderBy("place").collect()] == [(f"s.org/{n}", n) for n in range(13)]
    assert walked._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert graph.crawl_order(site, []).collect() == [] and graph.crawl_order(site, [None]).collect() == []
