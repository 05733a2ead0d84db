"""Merkle manifest, importance resampling and exact dedup against brute force, and their odd inputs."""

import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import queries
from corpusloom.llm.common import positions
from corpusloom.llm.exact_dedup import CountingQuotientFilter, exact_duplicates
from corpusloom.llm.importance import RunBuckets, resample
from corpusloom.llm.merkle import merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, path string, `_order` int, kept boolean, rank int"


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, names that the operators use themselves."""
    texts = [None, "", "Ab c\nd", "ab C\nD", "ÄB\x00\n", "x" * 70_000 + "\n word " * 30_000, "É e", "é e"]
    rows = []
    for n in range(60):
        text = texts[n % len(texts)]
        source = ["hot", None, "a", "é", ""][0 if n % 3 else n % 5]
        rows.append((None if n % 13 == 5 else n // 2 * 2 if n % 7 == 0 else n, text, None if n % 4 == 0 else "en", source, None if text is None else len(text), "p", n, True, 1))
    rows += rows[:6]
    return spark.createDataFrame(rows, SCHEMA).repartition(5), rows


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_importance_resampling", "op13_exact_dedup"])
def test_sql(spark, folder, name):
    frame = queries.QUERIES[name](spark, folder)
    with duckdb.connect() as connection:
        for table in ("documents", "benchmark"):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
        wanted = connection.sql(queries.SQL[name])
        assert sorted(wanted.columns) == sorted(frame.columns)
        assert sorted(map(repr, wanted.fetchall())) == sorted(map(repr, rows_of(frame.select(wanted.columns))))


def test_positions(spark):
    rows = [("a" if n % 3 else None, n % 11, n) for n in range(300)]
    frame = spark.createDataFrame(rows, "g string, v int, n int").repartition(7)
    found = rows_of(positions(frame, [F.col("v").desc(), F.col("n")], ["g"], "p", "s", "t"))
    for group, tree in ((None, 0), ("a", 1)):
        mine = sorted([r for r in rows if r[0] == group], key=lambda r: (-r[1], r[2]))
        assert sorted([r for r in found if r[0] == group], key=lambda r: r[3]) == [(*r, n, len(mine), tree) for n, r in enumerate(mine)]
    assert rows_of(positions(frame.limit(0), [F.col("v")])) == []


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def sealed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_of(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][n : n + fanout])) for n in range(0, len(levels[-1]), fanout)])
    return levels


def siblings(levels, at, fanout):
    for level in levels[:-1]:
        run = at // fanout * fanout
        yield "".join(level[run:at]), "".join(level[at + 1 : run + fanout])
        at //= fanout


@pytest.mark.parametrize("fanout", [2, 3])
def test_merkle_by_hand(spark, fanout):
    frame, rows = odd_documents(spark)
    shown = F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle_manifest(frame, fanout=fanout, presented={"text": shown})
    leaves = {}
    for doc_id, text, lang, source, n_chars, *_ in rows:
        seal = lambda t: digest("".join(map(sealed, (doc_id, source, lang, n_chars, t))))  # noqa: B023, E731
        other = text.replace("\n", "") if text is not None and doc_id is not None and doc_id % 2 == 0 else text
        leaves.setdefault(source, []).append(((doc_id is not None, doc_id or 0), seal(text), seal(other), doc_id))
    groups = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([leaf[1] for leaf in sorted(leaves[s])], fanout) for s in groups}
    top = levels_of([trees[s][-1][0] for s in groups], fanout)
    wanted = []
    for number, source in enumerate(groups):
        for at, (_, leaf, other, doc_id) in enumerate(sorted(leaves[source])):
            path = [*siblings(trees[source], at, fanout), *siblings(top, number, fanout)]
            node = other
            for left, right in path:
                node = digest(left + node + right)
            wanted.append((doc_id, leaf, trees[source][-1][0], top[-1][0], digest("".join(a + b for a, b in path)), node, node == top[-1][0]))
    assert sorted(map(repr, wanted)) == sorted(map(repr, rows_of(found.drop("path").select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))))


def test_merkle_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows_of(merkle_manifest(empty)) == []
    one = rows_of(merkle_manifest(spark.createDataFrame([(None,) * 9], SCHEMA)))[0]
    leaf = digest("-----")
    assert one == (None, leaf, leaf, leaf, digest(""), leaf, [], True)


def bucket_lists(raw, longest):
    words = [w.decode() for w in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", raw.lower())]
    runs = [" ".join(words[a : a + n]) for n in range(1, longest + 1) for a in range(len(words) - n + 1)]
    return len(words), sorted(zlib.crc32(r.encode()) % 97 for r in runs)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB9 -\nÉß語\x00 ", max_size=60), st.integers(1, 3))
def test_run_buckets(text, longest):
    runs = RunBuckets(longest, 97)
    words, found = runs.of(text.encode())
    assert (words, sorted(found.tolist())) == bucket_lists(text.encode(), longest)


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr("corpusloom.llm.importance.STRETCH", 7)
    text = "alpha beta-gamma, delta!epsilon 12 " * 9
    split = RunBuckets(2, 97)
    assert split.of(text.encode())[0] == 54
    whole, spans = split.words(text.encode())
    assert [whole[a:b] for a, b in spans] == re.findall("[a-z0-9]+", text)


@pytest.mark.parametrize("longest", [1, 2])
def test_resample_by_hand(spark, longest):
    frame, rows = odd_documents(spark)
    target = spark.createDataFrame([("ab word",), (None,), ("é e word",)], "text string")
    found = resample(frame, target, percent=30, least_words=2, longest=longest, buckets=97)
    lists = [(doc_id, *bucket_lists((text or "").encode(), longest)) for doc_id, text, *_ in rows]
    source, goal = np.zeros(97), np.zeros(97)
    for _, _, found_buckets in lists:
        np.add.at(source, found_buckets, 1)
    for text in ("ab word", "é e word"):
        np.add.at(goal, bucket_lists(text.encode(), longest)[1], 1)
    gain = [math.floor(1000 * math.log((t + 1) * (source.sum() + 97) / ((s + 1) * (goal.sum() + 97)))) for s, t in zip(source, goal)]
    scored = []
    for doc_id, words, mine in lists:
        weight = sum(gain[b] for b in mine) // len(mine) if mine else 0
        h = int(digest(f"2024:{'' if doc_id is None else doc_id}")[:8], 16)
        scored.append((doc_id, len(mine), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words))
    enough = sorted([r for r in scored if r[4] >= 2], key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[4]))
    drawn = 30 * len(enough) // 100
    wanted = [(*r[:4], n + 1 if n < drawn else None, r[4]) for n, r in enumerate(enough)] + [(*r[:4], None, r[4]) for r in scored if r[4] < 2]
    assert drawn > 5 and sorted(map(repr, wanted)) == sorted(map(repr, rows_of(found)))
    assert rows_of(resample(frame.limit(0), target)) == []
    assert len(rows_of(resample(frame, target.limit(0), least_words=2))) == len(rows)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 300) | st.integers(0, 2**58 - 1), max_size=40), min_size=1, max_size=5))
def test_filters_merge_without_loss(parts):
    built = [CountingQuotientFilter.of(np.array(p, np.uint64), np.ones(len(p), np.int64), 58) for p in parts]
    read = [CountingQuotientFilter.from_bytes(len(f.counts), *f.to_bytes(), 58) for f in built]
    whole = read[0].merged(read[1:])
    every = sorted(x for p in parts for x in p)
    assert dict(zip(whole.fingerprints().tolist(), whole.counts.tolist())) == {x: every.count(x) for x in every}
    assert whole.fingerprints().tolist() == sorted(set(every))


@pytest.mark.parametrize("bits", [64, 3, 1])
def test_copies_by_hand(spark, bits):
    """Also where most fingerprints collide: the bytes decide."""
    frame, rows = odd_documents(spark)
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault((text or "").encode().lower(), []).append(doc_id)
    found = rows_of(exact_duplicates(frame, fingerprint_bits=bits))
    ids = [doc_id for doc_id, *_ in rows]
    assert sorted(map(repr, ids)) == sorted(repr(r[0]) for r in found)
    names = {hashlib.sha256(t).hexdigest(): (max((i for i in g if i is not None), default=None), len(g)) for t, g in groups.items()}
    assert all((keep, size) == names[sha] for _, keep, size, _, sha in found)
    # One row of each group stays, and it is one of the largest id.
    kept = [r for r in found if r[3]]
    assert len(kept) == len(groups) and all(r[0] == r[1] for r in kept)
    assert rows_of(exact_duplicates(frame.limit(0))) == []


def test_copies_of_a_hot_text(spark):
    """A text of half of all rows among many that occur once: its rows stay where they are."""
    rows = [(n, "same Text" if n % 2 else f"text {n}", "x") for n in range(4000)]
    found = exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(4))
    result = found.groupBy("kept", "group_size").count().collect()
    assert sorted(tuple(r) for r in result) == [(False, 2000, 1999), (True, 1, 2000), (True, 2000, 1)]
    assert found.where("group_size > 1 AND keep_id <> 3999").isEmpty()
