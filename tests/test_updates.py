"""Graph index, updated versions, file index, bucketed upserts and threads: odd inputs and what the plans touch."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import graph_index
from corpusloom.operators.search import search_many
from corpusloom.operators.threads import header_ids, message_threads
from corpusloom.plans import build
from corpusloom.sources import file_index, layout
from corpusloom.streaming import buckets


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_graph_with_a_hot_vector(spark):
    """A third of all rows are copies of one vector; some have no direction, one another width."""
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 16))
    rows = [(n, (centres[n % 12] + 0.4 * rng.standard_normal(16)).tolist()) for n in range(600)]
    rows += [(1000 + n, centres[0].tolist()) for n in range(300)]
    rows += [(2000, [0.0] * 16), (2001, None), (2002, [1.0, 2.0]), (2003, [float("nan")] * 16)]
    corpus = spark.createDataFrame(rows, "chunk_id long, embedding array<float>").repartition(4)
    index = graph_index.build_graph(corpus, degree=12, rounds=3)
    assert index.members.count() == 900 and index.nodes.count() == 601
    degrees = index.edges.groupBy("node").count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert degrees[0] <= 12 and degrees[1] == 601
    asked = corpus.where("chunk_id % 30 = 0 AND chunk_id < 2000").select(F.col("chunk_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    asked = asked.unionByName(spark.createDataFrame([(9000, [0.0] * 16)], "query_id long, query_vector array<float>"))
    found = graph_index.search_graph(index, asked, 10, exclude_self=True)
    exact = search_many(corpus.where("chunk_id < 2000"), asked.where("query_id < 9000"), 10, exclude_self=True)
    judged = graph_index.recall(found, exact).agg(F.sum("wanted"), F.sum("found"), F.sum("right")).first()
    assert judged[0] == judged[1] and judged[2] >= 0.9 * judged[0]
    assert found.where("query_id = 9000").isEmpty()
    assert found.where("query_id = chunk_id").isEmpty()


def test_graph_is_stored_and_read(spark, tmp_path):
    corpus = spark.createDataFrame([(n, [float(n), 1.0]) for n in range(5)], "chunk_id long, embedding array<float>")
    graph_index.build_graph(corpus).write(str(tmp_path / "graph"))
    index = graph_index.GraphIndex.read(spark, str(tmp_path / "graph"))
    asked = spark.createDataFrame([(1, [0.0, 1.0])], "query_id long, query_vector array<double>")
    assert [r.chunk_id for r in graph_index.search_graph(index, asked, 3).orderBy("rank").collect()] == [0, 1, 2]
    empty = graph_index.build_graph(corpus.limit(0))
    assert empty.nodes.isEmpty() and graph_index.search_graph(empty, asked, 3).isEmpty()


def test_update_encodes_changed_chunks_only(spark, tmp_path):
    class Counting:
        """An encoder that writes down every text it is given."""

        def __init__(self, folder):
            self.path = f"{folder}/encoded"

        def encode(self, texts):
            with open(self.path, "a") as log:
                log.writelines(f"{len(t)}\n" for t in texts)
            return np.array([[len(t), 1.0] for t in texts], np.float32)

    text = " ".join(f"word{n}" for n in range(400))
    raw = lambda rows: spark.createDataFrame(
        [(u, "t", c, '{"license":"%s"}' % lic, n) for n, (u, c, lic) in enumerate(rows)], "url string, title string, content string, metadata string, n int"
    ).select("url", "title", "content", "metadata", F.timestamp_seconds("n").alias("crawled_at"))
    root, log = str(tmp_path / "root"), tmp_path / "encoded"
    folder = str(tmp_path)
    encoder = lambda: Counting(folder)
    build.build_version(raw([("a", text, "MIT"), ("b", text + " b", "MIT"), ("c", text, "MIT")]), root, "d", "v1.0.0", encoder=encoder)
    first = len(log.read_text().split())
    # a: another license; b: its end differs, so its last chunk does; c: gone; e: new.
    now = raw([("a", text, "CC0-1.0"), ("b", text + " changed", "MIT"), ("e", "new " * 40, "MIT"), ("f", "short", "MIT")])
    report = build.update_version(now, root, "d", "v1.1.0", encoder=encoder).first()
    assert (report.unchanged, report.changed, report.new, report.deleted, report.encoded) == (1, 1, 1, 1, 2)
    assert len(log.read_text().split()) == first + 2
    build.build_version(now, root, "again", "v1.1.0", encoder=encoder)
    for table in ("chunks", "embeddings", "documents", "attributions"):
        one, two = (layout.read_version(spark, root, table, d, "v1.1.0").drop("dataset", "version", "created_at", "processed_at") for d in ("d", "again"))
        assert rows_of(one) == rows_of(two)
    with pytest.raises(ValueError):
        build.update_version(now, root, "d", "v1.2.0", size=500)


def test_lookup_opens_few_files(spark, tmp_path):
    table, index = str(tmp_path / "table"), str(tmp_path / "index")
    rows = spark.range(4000).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.lit("x").alias("file")).unionByName(
        spark.createDataFrame([(None, "n"), ("k7", "again")], "key string, file string")
    )
    rows.repartition(20).write.parquet(table)
    file_index.build_index(spark, table, "key", index)
    found = file_index.lookup(spark, rows.schema, index, "key", ["k7", "k3999", "none", None])
    assert rows_of(found.select("key", "file")) == [("k3999", "x"), ("k7", "again"), ("k7", "x")]
    assert len(found.inputFiles()) <= 5
    assert file_index.lookup(spark, rows.schema, index, "key", ["absent"]).isEmpty()
    every = [f"k{n}" for n in range(0, 4000, 101)]
    assert file_index.lookup(spark, rows.schema, index, "key", every).count() == len(every)


def test_buckets(spark, tmp_path):
    target = str(tmp_path / "t")
    schema = "k string, n int, v string, first string"
    batch = lambda *rows: spark.createDataFrame(list(rows), schema)
    read = lambda: rows_of(buckets.read_buckets(spark, target, batch().schema).drop("bucket"))
    assert read() == []
    buckets.upsert_buckets(batch(("a", 1, "x", "1"), ("a", 2, "y", "2"), ("b", 1, "z", "3"), (None, 1, "null", "4")), target, "k", ["n"], 8, ("first",))
    assert read() == [("a", 2, "y", "1"), ("b", 1, "z", "3"), (None, 1, "null", "4")]
    again = batch(("a", 2, "later", "5"), ("b", 0, "old", "6"), ("c", 1, None, "7"))
    for _ in range(2):  # a replay changes nothing
        buckets.upsert_buckets(again, target, "k", ["n"], 8, ("first",))
        assert read() == [("a", 2, "later", "1"), ("b", 1, "z", "3"), ("c", 1, None, "7"), (None, 1, "null", "4")]
    assert buckets.upsert_buckets(batch(), target, "k", ["n"], 8) == []


def test_threads(spark):
    rows = [
        ("a", None, None), ("b", "<a>", None), ("c", "<x> (comment)", "<a>\n <b>"), ("d", None, "<a> <missing> <gone>"), ("e", "<gone>", None),
        ("self", "<self>", None), ("p", "<q>", None), ("q", "<p>", None), ("below", "<q>", None), ("b", "<zzz>", None), (None, "<a>", None), ("f", "no id", ""),
    ]
    found = message_threads(spark.createDataFrame(rows, "message_id string, in_reply_to string, references string"))
    wanted = [
        ("a", None, None, "a", 0), ("b", "a", True, "a", 1), ("c", "b", True, "a", 2), ("d", "gone", False, "a", 3), ("e", "gone", False, "a", 3),
        ("self", None, None, "self", 0), ("p", "q", True, "p", 0), ("q", "p", True, "q", 0), ("below", "q", True, "below", 0), ("f", None, None, "f", 0),
    ]
    assert rows_of(found) == sorted(wanted, key=repr)
    ids = spark.createDataFrame([("< a@b >,<c>", None)], "h string, n string").select(header_ids("h").alias("h"), header_ids("n").alias("n")).first()
    assert (ids.h, ids.n) == (["a@b", "c"], [])
