import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.versions import version_key
from corpusloom.operators import clean, govern, graph, registry, stats, upsert
from corpusloom.operators.skew import hot_keys, join_on_hot_key, join_unique, latest_per_key
from corpusloom.sources import crawl, layout, tables
from corpusloom.streaming import incremental


def rows_of(frame):
    return sorted(tuple(r) for r in frame.collect())


# --- skew ---------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows has key 7, some keys are null, some have no partner."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 400).alias("k"),
        F.col("id").alias("v"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("limit", [3, 100000])
def test_join_on_hot_key(spark, skewed, how, limit):
    right = spark.range(0, 500, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    odd = right.unionByName(spark.createDataFrame([(7, 70)], "k long, w long"))
    for partner in (right, odd):
        expected = skewed.join(partner, "k", how)
        key = lambda r: tuple((x is None, x or 0) for x in r)
        wanted = sorted(map(tuple, expected.collect()), key=key)
        assert sorted(map(tuple, join_on_hot_key(skewed, partner, "k", how, limit).collect()), key=key) == wanted
        assert sorted(map(tuple, join_unique(skewed, partner, "k", how, max_rows=10).collect()), key=key) == wanted


def test_hot_keys(skewed):
    assert [r[0] for r in hot_keys(skewed, "k", 10).collect()] == [7]


def test_latest_per_key(spark):
    rows = [("a", 1, "old", "x"), ("a", 3, "new", "y"), ("b", None, "null", "z"), ("c", 2, "p", "q"), ("c", 2, "r", "s"), ("c", None, "t", "u")]
    frame = spark.createDataFrame(rows, "k string, t int, v string, f string")
    assert rows_of(latest_per_key(frame, ["k"], ["t", "v"])) == [("a", 3, "new", "y"), ("b", None, "null", "z"), ("c", 2, "r", "s")]
    kept = latest_per_key(frame.where("k = 'a'"), ["k"], ["t"], keep_first=("f",)).first()
    assert (kept.v, kept.f) == ("new", "x")


# --- cleaning and upsert ------------------------------------------------------------------------------------------

def test_clean_documents(spark):
    long = "<p>" + "x" * 60 + "</p>"
    rows = [
        ("u1", "t", long, '{"license":"CC0-1.0","author":null}', datetime.datetime(2024, 1, 2)),
        ("u1", "t", long + "old", "{}", datetime.datetime(2024, 1, 1)),
        ("u2", None, "y" * 50, None, None), ("u3", None, None, None, None), ("u4", None, "z" * 51, "not json", None),
    ]
    raw = spark.createDataFrame(rows, "url string, title string, content string, metadata string, crawled_at timestamp_ntz")
    docs = clean.dedup_latest(clean.clean_documents(raw), key="source_url", tie="id")
    found = {r.source_url: r for r in docs.collect()}
    assert set(found) == {"u1", "u4"}
    assert found["u1"].content == "x" * 60 and (found["u1"].license, found["u1"].author) == ("CC0-1.0", "Unknown")
    assert found["u4"].license == "MIT"
    assert clean.clean_documents(raw, 100, "unknown").count() == 0


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", "t1"), (2, "b", "t2")], "id int, v string, first string")
    updates = spark.createDataFrame([(2, "x", 1), (2, None, 2), (3, "c", 1)], "id int, v string, n int")
    merged = upsert.upsert(target, updates, "id", ["n"], {"first": F.lit("now")})
    assert rows_of(merged) == [(1, "a", "t1"), (2, None, "t2"), (3, "c", "now")]
    again = upsert.upsert(merged, updates, "id", ["n"], {"first": F.lit("later")})
    assert rows_of(again) == rows_of(merged)


def test_changed_documents(spark):
    current = spark.createDataFrame([("a", "same"), ("b", "new text"), ("c", "added")], "id string, content string")
    seen = spark.createDataFrame([("a", "same"), ("b", "old"), ("d", "gone")], "id string, content string")
    seen = seen.select("id", F.md5("content").alias("content_md5"))
    assert [r.id for r in upsert.changed_documents(current, seen).orderBy("id").collect()] == ["b", "c"]


def test_item_depths(spark):
    edges = [(1, None), (2, 1), (3, 2), (4, 3), (5, 4), (6, 1), (10, None), (20, 99), (21, 20), (30, 31), (31, 30), (32, 30)]
    items = spark.createDataFrame(edges + [(100 + i, 1) for i in range(50)], "id long, parent long")
    found = {r.id: (r.root, r.depth) for r in graph.item_depths(items).collect()}
    wanted = {1: (1, 0), 2: (1, 1), 3: (1, 2), 4: (1, 3), 5: (1, 4), 6: (1, 1), 10: (10, 0)} | {100 + i: (1, 1) for i in range(50)}
    assert found == wanted


def test_item_children(spark):
    items = spark.createDataFrame([(1, [3, 2, 9], "p"), (2, None, "x"), (3, [], "y")], "id long, kids array<long>, t string")
    assert rows_of(graph.item_children(items).select("parent_id", "position", "child_id", "t")) == [(1, 0, 3, "y"), (1, 1, 2, "x")]


# --- statistics and governance ------------------------------------------------------------------------------------

def test_checksum_ignores_order_and_partitions(spark):
    rows = [(t,) for t in ["a", "b", "b", "c", None] * 20]
    one = stats.content_checksum(spark.createDataFrame(rows, "t string").coalesce(1), "t").first()
    other = stats.content_checksum(spark.createDataFrame(rows[::-1], "t string").repartition(9), "t").first()
    fewer = stats.content_checksum(spark.createDataFrame(rows[:-3], "t string"), "t").first()
    assert one == other and one.row_count == 80
    assert one.content_checksum != fewer.content_checksum
    wide = stats.content_checksum(spark.createDataFrame(rows, "t string"), "t", "sha256").first()
    assert len(wide.content_checksum) == 64


def test_manifest_counts_documents_without_chunks(spark):
    docs = spark.createDataFrame([("x" * 1900,), ("short",), (None,), ("",)], "content string")
    row = stats.build_summary(stats.grid_manifest(docs, "d", "v1")).first()
    assert (row.documents, row.chunks) == (4, 3)
    empty = stats.grid_manifest(docs.where("false"), "d", "v1").first()
    assert (empty.document_count, empty.chunk_count) == (0, 0)


def test_mean_is_rounded_half_to_even(spark):
    for lengths, mean in (((2, 3), 2), ((3, 4), 4)):
        frame = spark.createDataFrame([("t", "a", "x" * n, n) for n in lengths], "t string, a string, c string, d int")
        assert stats.corpus_stats(frame, "t", "a", "c", "d").first().avg_content_length == mean


def test_cost(spark):
    usage = spark.createDataFrame([("a", 15.0, 10.0, 1000.0, 1e6)], "d string, storage_gb double, egress_gb double, embedding_ktokens double, search_calls double")
    assert stats.monthly_cost(usage).first()[0] == pytest.approx(15 * 0.023 + 10 * 0.09 + 0.1 + 2)


def test_personal_data(spark):
    text = "write to Jo.Doe+x@mail.example.org or 10.0.0.255, call +49 (30) 1234 5678; v1.2.3 stays"
    rows = govern.scrub_personal_data(spark.createDataFrame([(text,), ("clean",), (None,)], "t string"), "t").collect()
    assert rows[0].t == "write to [EMAIL] or [IP], call [PHONE]; v1.2.3 stays"
    assert (rows[0].email_hits, rows[0].ip_hits, rows[0].phone_hits) == (1, 1, 1)
    assert (rows[1].t, rows[1].email_hits) == ("clean", 0) and rows[2].t is None


def test_long_addresses_do_not_exhaust_the_stack(spark):
    text = "a@" + "b." * 20000 + "c"
    row = govern.scrub_personal_data(spark.createDataFrame([(text,)], "t string"), "t").first()
    assert row.t == "[EMAIL]"


def test_licenses(spark):
    cases = {
        "Released under the MIT License.": "MIT", "licensed under the apache license": "Apache-2.0", "cc by-nc 4.0": "CC-BY-NC-4.0",
        "CC-BY 4.0": "CC-BY-4.0", "cc0": "CC0-1.0", "Creative commons zero": "CC0-1.0", "ODBL": "ODbL-1.0", "GPL v3": "GPL-3.0", "": None,
    }
    frame = spark.createDataFrame([(c,) for c in cases], "t string")
    found = frame.select("t", govern.detect_license("t").alias("license"))
    assert {r.t: r.license for r in found.collect()} == cases
    policy = {r.t: r for r in govern.license_policy(found).collect()}
    assert policy["cc by-nc 4.0"].commercial_use is False and policy["GPL v3"].known_license is False


def test_takedowns_and_filter(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "source_url string, n int")
    listed = spark.createDataFrame([("a",), ("a",), ("z",)], "source_url string")
    for bound in (100, 1):
        left = govern.without_takedowns(rows, listed, max_broadcast=bound)
        assert sorted(r.n for r in left.collect()) == [2, 3]
    docs = spark.createDataFrame([(i,) for i in range(4)], "doc_id int")
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 1), (2, 0, 0)], "doc_id int, quality int, toxic int")
    assert sorted(r.doc_id for r in govern.content_filter(docs, labels).collect()) == [0, 3]


def test_constraints(spark):
    rows = spark.createDataFrame([(1, "a"), (1, None), (2, None), (None, "x"), (None, "y")], "id int, v string")
    found = rows_of(govern.constraint_report(rows, "id", ["id", "v"]))
    assert found == [("not_null", "id", 2), ("not_null", "v", 2), ("unique", "id", 1)]


def test_health(spark):
    day = datetime.datetime
    manifests = spark.createDataFrame(
        [("a", "v1", 1, day(2024, 1, 1)), ("b", "v1", 1, day(2024, 1, 8))], "dataset string, version string, row_count long, created_at timestamp_ntz"
    )
    known = spark.createDataFrame([("a", "v1"), ("b", "v1"), ("c", "v9")], "name string, current_version string")
    as_of = F.lit("2024-01-14 23:59:59").cast("timestamp_ntz")
    found = {r.dataset: (r.age_days, r.status) for r in registry.dataset_health(known, manifests, as_of).collect()}
    assert found == {"a": (13, "stale"), "b": (6, "healthy"), "c": (None, "missing")}


# --- storage ------------------------------------------------------------------------------------------------------

def test_versions_sort_by_number(spark):
    frame = spark.createDataFrame([("v2024.9.1",), ("v2024.12.1",), ("v2023.99.0",)], "v string")
    assert [r.v for r in frame.orderBy(version_key("v").desc()).collect()] == ["v2024.12.1", "v2024.9.1", "v2023.99.0"]


@pytest.mark.parametrize("compression", ["zstd", "snappy", "gzip"])
def test_layout(spark, tmp_path, compression):
    root = str(tmp_path / "root")
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(100)], "id long, content string").repartition(3)
    manifest = layout.write_version(docs, root, "documents", "d", "v2024.9.1", compression, checksum_of="content").first()
    layout.write_version(docs.where("id < 10"), root, "documents", "d", "v2024.12.1", compression)
    layout.write_version(docs, root, "embeddings", "d", "v2024.12.1", compression)
    layout.write_version(docs, root, "documents", "e", "v1", compression)
    assert manifest.row_count == 100
    assert manifest.content_checksum == stats.content_checksum(docs, "content").first().content_checksum
    assert layout.read_version(spark, root, "documents", "d").count() == 10
    assert layout.read_version(spark, root, "documents", "d", "v2024.9.1").count() == 100
    known = layout.read_manifests(spark, root)
    assert rows_of(registry.list_datasets(known)) == [("d",), ("e",)]
    assert [r.version for r in registry.list_versions(known, "d").collect()] == ["v2024.12.1", "v2024.9.1"]
    stored = layout.read_manifest(spark, root, "d", "v2024.9.1", "documents").first()
    assert (stored.row_count, stored.compression, stored.columns) == (100, compression, ["id", "content"])
    assert stored.content_checksum == manifest.content_checksum
    files = layout.version_files(layout.read_all_versions(spark, root, "documents", with_files=True))
    sums = files.groupBy("dataset", "version").agg(F.sum("row_count"))
    assert rows_of(sums) == [("d", "v2024.12.1", 10), ("d", "v2024.9.1", 100), ("e", "v1", 100)]
    with pytest.raises(FileExistsError):
        layout.write_version(docs, root, "documents", "d", "v2024.9.1", compression)
    with pytest.raises(LookupError):
        layout.read_version(spark, root, "documents", "nobody")
    with pytest.raises(ValueError):
        layout.write_version(docs, root, "documents", "d", "v3", "none")


def test_release_and_delete(spark, tmp_path):
    root = str(tmp_path / "root")
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(10)], "id long, content string")
    layout.write_version(docs, root, "documents", "2024", "v1")
    layout.write_version(docs, root, "documents", "2024", "v2", released=False)
    layout.write_version(docs.limit(4), root, "documents", "2024", "v2", released=False)
    assert layout.resolve_version(spark, root, "2024") == "v1"
    assert layout.read_all_versions(spark, root, "documents").count() == 10
    assert layout.read_version(spark, root, "documents", "2024", "v2").count() == 4
    layout.release(spark, root, "2024", "v2", ["documents"])
    newest = layout.read_version(spark, root, "documents", "2024")
    assert newest.count() == 4 and newest.schema["dataset"].dataType.simpleString() == "string"
    assert layout.delete_version(spark, root, "2024", "v2") == ["documents"]
    assert layout.resolve_version(spark, root, "2024") == "v1" and not (tmp_path / "root/documents/dataset=2024/version=v2").exists()
    layout.write_version(docs, root, "documents", "2024", "v2")
    assert layout.read_version(spark, root, "documents", "2024").count() == 10


def test_catalog_table(spark):
    space = f"ns_{uuid.uuid4().hex}"
    tables.ensure_namespace(spark, space)
    tables.ensure_namespace(spark, space)
    name = f"{space}.emb"
    rows = spark.createDataFrame([("v1", 1, "d", 0.5), ("v2", 2, "d", 1.5), ("v2", 3, "it's", 2.5)], "version string, id long, dataset string, x double")
    schema = rows.select("id", F.col("x").cast("float").alias("x"), "dataset", "version").schema
    assert tables.ensure_table(spark, name, schema, ("dataset", "version")) is True
    assert tables.ensure_table(spark, name, schema, ("dataset", "version")) is False
    tables.append_rows(rows, name)
    tables.append_rows(rows, name, ("dataset", "version"))
    assert spark.table(name).count() == 6 and spark.table(name).schema["x"].dataType.simpleString() == "float"
    tables.overwrite_rows(rows, name)
    assert spark.table(name).count() == 3
    tables.delete_version(spark, name, "it's", "v2")
    tables.delete_version(spark, name, "nobody", "v2")
    assert rows_of(tables.list_partitions(spark, name)) == [("d", "v1"), ("d", "v2")]
    assert rows_of(spark.table(name).select("id")) == [(1,), (2,)]
    assert space in tables.list_namespaces(spark) and tables.list_tables(spark, space) == ["emb"]
    tables.drop_table(spark, name)
    assert tables.list_tables(spark, space) == []


def test_required_columns(spark):
    from corpusloom.schemas import MESSAGES

    space = f"ns_{uuid.uuid4().hex}"
    tables.ensure_namespace(spark, space)
    assert tables.ensure_table(spark, f"{space}.messages", MESSAGES)
    assert tables.table_schema(spark, f"{space}.messages") == MESSAGES
    rows = spark.createDataFrame([("a",)], "id string").select(*[F.col("id") if f.name == "id" else F.lit(None).cast(f.dataType).alias(f.name) for f in MESSAGES])
    tables.append_rows(rows, f"{space}.messages")
    with pytest.raises(Exception, match="id is required"):
        tables.append_rows(rows.withColumn("id", F.lit(None).cast("string")), f"{space}.messages")
    assert spark.table(f"{space}.messages").count() == 1


def test_json_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"url":"u1","content":"c","metadata":"{}","extra":1},\n {"url":"u2"}]')
    rows = crawl.read_json(spark, str(tmp_path / "*.json"), multiline=True)
    assert [r.url for r in rows.orderBy("url").collect()] == ["u1", "u2"]
    crawl.write_jsonl(rows, str(tmp_path / "out"), "gzip")
    assert crawl.read_json(spark, str(tmp_path / "out")).count() == 2


# --- incremental --------------------------------------------------------------------------------------------------

SCHEMA = "id long, v string, t long, first string"


def add_file(spark, folder, rows, number):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/in{number}")


def test_ingest_reads_only_new_files(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("src", "dst", "progress"))
    schema = spark.createDataFrame([], SCHEMA).schema
    counts = []
    for number, rows in enumerate([[(1, "a", 1, "x")], [], [(2, "b", 1, "y"), (3, "c", 1, "z")]]):
        if rows:
            add_file(spark, source, rows, number)
        incremental.ingest_new(incremental.file_stream(spark, f"{source}/in*", schema), target, progress)
        counts.append(spark.read.schema(schema).parquet(target).count())
    assert counts == [1, 1, 3]


def test_upsert_stream_is_idempotent(spark, tmp_path):
    source, target, progress, fresh = (str(tmp_path / n) for n in ("src", "log", "progress", "fresh"))
    schema = spark.createDataFrame([], SCHEMA).schema
    add_file(spark, source, [(1, "a", 1, "f1"), (1, "b", 2, "f2"), (2, "x", 5, "f3")], 0)

    def run(checkpoint):
        stream = incremental.file_stream(spark, f"{source}/in*", schema)
        incremental.upsert_new(stream, target, checkpoint, "id", ["t"])
        return rows_of(incremental.current_rows(spark, target, "id", ["t"], keep_first=("first",)))

    assert run(progress) == [(1, "b", 2, "f2"), (2, "x", 5, "f3")]
    assert run(progress) == [(1, "b", 2, "f2"), (2, "x", 5, "f3")]
    add_file(spark, source, [(1, "c", 3, "f9"), (2, "late", 4, "f0"), (3, "n", 1, "f4")], 1)
    after = [(1, "c", 3, "f2"), (2, "x", 5, "f0"), (3, "n", 1, "f4")]
    assert run(progress) == after
    incremental.compact(spark, target, fresh, "id", ["t"], keep_first=("first",))
    assert rows_of(incremental.current_rows(spark, fresh, "id", ["t"], keep_first=("first",))) == after
