"""Groups of similar vectors and connected components against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from corpusloom.operators import similar
from corpusloom.operators.graph import components


def closure(names, pairs):
    label = {n: n for n in names}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def brute(rows, threshold):
    """Group, links and copies of every row, by all pairs."""
    width = 16
    fits = {n: v for n, v in rows if v is not None and len(v) == width and np.isfinite(v).all() and np.linalg.norm(v) > 0}
    first = {}
    for n in sorted(fits):
        first.setdefault(tuple(fits[n]), n)
    owner = {n: first[tuple(v)] for n, v in fits.items()}
    names = sorted(set(owner.values()))
    matrix = np.array([fits[n] for n in names], float)
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    near = np.round(matrix @ matrix.T, 12) >= threshold
    pairs = [(names[i], names[j]) for i, j in zip(*np.nonzero(np.triu(near, 1)))]
    label = closure(names, pairs)
    links = dict(zip(names, near.sum(axis=1) - 1))
    held = list(owner.values())
    return {n: (label[owner[n]], links[owner[n]], held.count(owner[n])) if n in owner else (n, 0, 1) for n, _ in rows}


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    found = [rng.standard_normal(16) for _ in range(300)]
    # A crowd of a third of all rows, small groups at all distances, a chain, and copies.
    crowd = rng.standard_normal(16)
    found += [crowd + 0.08 * rng.standard_normal(16) for _ in range(200)]
    found += [found[n % 60] + (0.02 + 0.004 * n) * rng.standard_normal(16) for n in range(120)]
    chain = [rng.standard_normal(16)]
    for _ in range(30):
        chain.append(chain[-1] + 0.15 * rng.standard_normal(16))
    found += chain + [found[5]] * 40 + [found[300]] * 10 + [2 * found[7]]
    order = rng.permutation(len(found))
    listed = [(int(n), [float(x) for x in np.float32(found[i])]) for n, i in enumerate(order)]
    odd = [None, [0.0] * 16, [1.0] * 8, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, []]
    return listed + [(1000 + n, v) for n, v in enumerate(odd)]


@pytest.mark.parametrize("threshold,block", [(0.95, 512), (0.95, 32), (0.9, 64)])
def test_groups_against_brute_force(spark, rows, threshold, block, monkeypatch):
    monkeypatch.setattr(similar, "BLOCK", block)
    monkeypatch.setattr(similar, "SENT", 8)
    frame = spark.createDataFrame(rows, "chunk_id long, embedding array<float>").repartition(5)
    found = {r.chunk_id: (r.group_id, r.links, r.copies) for r in similar.similar_groups(frame, threshold, 1e-9).collect()}
    wanted = brute([(n, None if v is None else np.float32(v)) for n, v in rows], threshold)
    assert found == wanted
    assert max(links for _, links, _ in wanted.values()) > 150


def test_groups_of_few_rows(spark):
    schema = "id string, v array<float>, _vector int, node int"
    for rows in ([], [("a", None, 1, 2)], [("b", [1.0, 0.0], 1, 2), ("a", [1.0, 0.0], 1, 2), ("a", [1.0, 0.0], 3, 4)]):
        found = similar.similar_groups(spark.createDataFrame(rows, schema), 0.9, chunk_id="id", vector="v").collect()
        assert sorted((r.id, r.group_id, r.links, r.copies) for r in found) == sorted((r[0], "a", 0, max(1, len(rows))) for r in rows)


def test_tables_keep_the_chance_of_a_miss():
    for others in (np.zeros(0), np.linspace(-0.2, 0.2, 50), np.linspace(0.5, 0.8, 50)):
        for threshold in (0.8, 0.95, 1.0):
            chosen = [similar.projections(nodes, threshold, 1e-4, others[others < threshold]) for nodes in (1, 1000, 10**6, 10**9)]
            for signs, tables in chosen:
                together = (1 - np.arccos(threshold) / np.pi) ** signs
                assert (1 - together) ** tables <= 1e-4
            assert chosen == sorted(chosen)


def test_components(spark):
    rng = np.random.default_rng(5)
    pairs = [(n, n + 1) for n in range(100, 160)] + [(500, n) for n in range(501, 800)] + [(9, 9), (30, 20), (20, 30)]
    pairs += [tuple(int(x) for x in rng.integers(1000, 1400, 2)) for _ in range(250)]
    shuffled = [pairs[i] for i in rng.permutation(len(pairs))]
    label = closure({n for p in pairs for n in p}, pairs)
    found = {r.node: r.component for r in components(spark.createDataFrame(shuffled, "a long, b long")).collect()}
    assert found == {n: low for n, low in label.items() if n != low}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("way", ["cells", "tables"])
def test_both_ways_against_brute_force(spark, rows, way, monkeypatch):
    monkeypatch.setattr(similar, "BLOCK", 64)
    monkeypatch.setattr(similar, "SLAB", 500)
    monkeypatch.setattr(similar, "tables_work", lambda *_: np.inf if way == "cells" else -1.0)
    frame = spark.createDataFrame(rows, "chunk_id long, embedding array<float>").repartition(5)
    found = {r.chunk_id: (r.group_id, r.links, r.copies) for r in similar.similar_groups(frame, 0.95, 1e-9).collect()}
    assert found == brute([(n, None if v is None else np.float32(v)) for n, v in rows], 0.95)


def test_vectors_in_narrow_cones_are_sent_a_few_times():
    rng = np.random.default_rng(11)
    cones = np.abs(rng.standard_normal((8, 64)))
    vectors = np.concatenate([c / np.linalg.norm(c) + 0.04 * rng.standard_normal((250, 64)) for c in cones])
    vectors[1::5] = vectors[::5] + 0.01 * rng.standard_normal((400, 64))
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    centres, work = similar.centres_for(units[::2], len(units), 0.98)
    others = (units[::2] @ units[::2].T)[np.triu_indices(1000, 1)]
    others = others[others < 0.98]
    assert work < similar.tables_work(len(units), *similar.projections(len(units), 0.98, 1e-4, others), others)
    own, visits = similar.cells_of(units, centres, 0.98)
    assert visits.sum() < 2 * len(units)
    # Linked rows meet once: in the cell of both, or in the earlier one of their two.
    left, right = np.nonzero(np.triu(units @ units.T >= 0.98, 1))
    later = np.where(own[left] > own[right], left, right)
    assert len(left) > 300 and (visits[later, np.minimum(own[left], own[right])] | (own[left] == own[right])).all()
    assert not visits[np.arange(len(own)), own].any()


def shuffled(spark):
    """Bytes that all stages so far have written into shuffle files."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return {(s.stageId(), s.attemptId()): s.shuffleWriteBytes() for s in (stages.apply(i) for i in range(stages.size()))}


@pytest.mark.parametrize("way", ["cells", "tables"])
def test_a_crowd_is_not_sent_once_for_every_block_it_meets(spark, way, monkeypatch):
    monkeypatch.setattr(similar, "tables_work", lambda *_: np.inf if way == "cells" else -1.0)
    rng = np.random.default_rng(7)
    vectors = rng.standard_normal(64) + 0.05 * rng.standard_normal((1500, 64))
    frame = spark.createDataFrame([(n, v) for n, v in enumerate(vectors.tolist())], "chunk_id long, embedding array<float>")
    sent = {}
    for block in (8192, 100):
        monkeypatch.setattr(similar, "BLOCK", block)
        before = shuffled(spark)
        found = similar.similar_groups(frame, 0.99)
        assert {(r.group_id, r.links, r.copies) for r in found.collect()} == {(0, 1499, 1)}
        sent[block] = sum(n for stage, n in shuffled(spark).items() if stage not in before)
    assert sent[100] < 2 * sent[8192]


def test_the_number_of_nodes_does_not_raise_how_often_one_is_sent():
    rng = np.random.default_rng(13)
    for threshold in (0.8, 0.95, 0.98):
        assert similar.projections(10**9, threshold, 1e-4, np.linspace(-0.2, 0.2, 50))[1] <= similar.MOST_TABLES
        noise = rng.standard_normal(16) / 2 + rng.standard_normal((1000, 16))
        units = noise / np.linalg.norm(noise, axis=1, keepdims=True)
        centres, _ = similar.centres_for(units, 10**9, threshold)
        assert similar.cells_of(units, centres, threshold)[1].sum() <= similar.MOST_VISITS * len(units)


def test_similarities_close_to_the_threshold(spark, monkeypatch):
    """Single precision cannot tell them from the threshold."""
    monkeypatch.setattr(similar, "BLOCK", 16)
    offsets = [s * 10.0**-n for n in range(6, 14) for s in (1, -1)] + [0.0]
    angles = [n + turn for n in range(3) for turn in [0.0] + [np.arccos(0.9 + o) for o in offsets]]
    vectors = [[float(np.cos(a)), float(np.sin(a))] for a in angles]
    frame = spark.createDataFrame(list(enumerate(vectors)), "chunk_id long, embedding array<double>").repartition(3)
    matrix = np.array(vectors)
    near = np.round(matrix @ matrix.T, 12) >= 0.9
    label = closure(range(len(vectors)), list(zip(*(x.tolist() for x in np.nonzero(np.triu(near, 1))))))
    found = {r.chunk_id: (r.group_id, r.links) for r in similar.similar_groups(frame, 0.9).collect()}
    assert found == {n: (label[n], near[n].sum() - 1) for n in range(len(vectors))}


def test_a_vector_is_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @arrow_udf("array<float>")
    def model(numbers: pa.Array) -> pa.Array:
        made.add(len(numbers))
        return pa.array([[1.0, float(n)] for n in numbers.to_pylist()], pa.list_(pa.float32()))

    found = similar.similar_groups(spark.range(50).select(F.col("id").alias("chunk_id"), model("id").alias("embedding")))
    assert found.count() == 50 and made.value == 50
