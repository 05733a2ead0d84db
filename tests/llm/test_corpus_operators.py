"""Searches, mixing, URL rules and near-duplicates against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import near_dedup
from corpusloom.llm.approx_search import nearest
from corpusloom.llm.exact_search import top_products
from corpusloom.llm.graph import components
from corpusloom.llm.mixing import mix
from corpusloom.llm.near_dedup import near_duplicates
from corpusloom.llm.queries import QUERIES, SQL, URL_RULES
from corpusloom.llm.url_rules import judge_urls, mine_rules

VECTOR = "vec_id long, embedding array<float>"


def odd_vectors(seed, count=400, width=8):
    rng = np.random.default_rng(seed)
    rows = [(n, [float(np.float32(x)) for x in rng.standard_normal(width) * rng.choice([0.1, 1, 3])]) for n in range(count)]
    rows += [(1000, [0.0] * width), (1100, None), (1200, []), (1300, [None] + [1.0] * (width - 1)), (1400, [math.nan] * width), (1500, [math.inf] * width)]
    rows += [(n, rows[7][1]) for n in range(2000, 2040)]  # one common vector: ties
    rows += [(100, rows[100][1]), (None, rows[3][1]), (1600, [0.5, -0.25])]
    return rows


def brute_top(rows, k, usable, score):
    vectors = {}
    for vec_id, v in rows:
        if vec_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and usable(v):
            vectors.setdefault(vec_id, []).append(list(v) + [0.0] * (8 - len(v)))
    result = {}
    for q in (i for i in vectors if i % 100 == 0):
        scored = [(max(score(a, b) for a in vectors[q] for b in vectors[c]), c) for c in vectors if c != q]
        result[q] = [(c, s) for s, c in sorted(scored, key=lambda x: (-x[0], x[1]))[:k]]
    return result


def as_lists(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    return found


def test_exact_products(spark):
    rows = odd_vectors(1)
    docs = spark.createDataFrame([(*r, "x") for r in rows], VECTOR + ", list string")
    floor = lambda v: [math.floor(1024 * x) for x in v]
    wanted = brute_top(rows, 10, lambda v: True, lambda a, b: sum(x * y for x, y in zip(floor(a), floor(b))))
    assert as_lists(top_products(docs).collect()) == wanted
    assert top_products(docs.limit(0)).collect() == []


def test_exact_products_over_many_blocks(spark, monkeypatch):
    from corpusloom.llm import exact_search, vector_blocks

    monkeypatch.setattr(vector_blocks, "BLOCK_CANDIDATES", 16)
    monkeypatch.setattr(vector_blocks, "BLOCK_QUERIES", 2)
    monkeypatch.setattr(exact_search, "BUCKETS", 4)
    monkeypatch.setattr(exact_search, "SEEDS", 12)
    monkeypatch.setattr(exact_search, "STRIP", 4)
    rows = odd_vectors(2)
    floor = lambda v: [math.floor(1024 * x) for x in v]
    wanted = brute_top(rows, 5, lambda v: True, lambda a, b: sum(x * y for x, y in zip(floor(a), floor(b))))
    assert as_lists(top_products(spark.createDataFrame(rows, VECTOR), k=5).collect()) == wanted


def test_huge_components_do_not_overflow(spark):
    rows = [(0, [3e38, 3e38]), (1, [3e38, 3e38]), (2, [-3e38, -3e38])]
    found = as_lists(top_products(spark.createDataFrame(rows, VECTOR)).collect())
    assert found == {0: [(1, 2**63 - 1), (2, -(2**63))]}


@pytest.mark.parametrize("recall", [1.0, 0.95])
def test_nearest(spark, recall, monkeypatch):
    from corpusloom.llm import approx_search

    monkeypatch.setattr(approx_search, "ROWS_PER_LIST", 20)
    rows = odd_vectors(3)
    docs = spark.createDataFrame([(*r, "x") for r in rows], VECTOR + ", score string")
    distance = lambda a, b: -math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b)))
    wanted = brute_top(rows, 10, lambda v: any(v), distance)
    found = as_lists(nearest(docs, recall=recall).collect())
    assert set(found) == set(wanted)
    hits = [len({c for c, _ in found[q]} & {c for c, _ in wanted[q]}) / len(wanted[q]) for q in wanted]
    assert np.mean(hits) >= 0.9
    scores = {(q, c): -s for q in wanted for c, s in wanted[q]}
    assert all(abs(s - scores[q, c]) < 1e-9 for q in found for c, s in found[q] if (q, c) in scores)
    assert nearest(docs.limit(0)).collect() == []


def test_sample_of_lists_is_bounded_when_a_row_repeats(spark, monkeypatch):
    from corpusloom.llm import approx_search

    monkeypatch.setattr(approx_search, "SAMPLE", 16)
    seen = []
    monkeypatch.setattr(approx_search, "train_lists", lambda sample, lists, train=approx_search.train_lists: seen.append(len(sample)) or train(sample, lists))
    rng = np.random.default_rng(4)
    rows = [(300, [1.0, 2.0, 3.0])] * 400 + [(n, rng.normal(size=3).tolist()) for n in range(400)]
    found = as_lists(nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert 0 < seen[0] <= 32 and sorted(found) == [0, 100, 200, 300] and all(len(hits) == 10 for hits in found.values())


def test_recall_on_the_table(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    table = np.array([r[1] for r in rows])
    found = as_lists(QUERIES["op8_adaptive_scan"](spark, folder).collect())
    for query, hits in found.items():
        gaps = np.sqrt(((table - table[query]) ** 2).sum(axis=1))
        gaps[query] = np.inf
        assert len({c for c, _ in hits} & set(np.argsort(gaps, kind="stable")[:10].tolist())) >= 9


DOC = "doc_id long, text string, source string"


def brute_targets(sizes, most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [None] * (None in sizes)
    weights = {s: n % 3 + 1 for n, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        weight = sum(weights[s] for s in names if s not in capped)
        targets = {s: most * sizes[s] if s in capped else left * weights[s] / weight for s in names}
        over = {s for s in names if s not in capped and targets[s] > most * sizes[s]}
        if not over:
            return targets
        capped |= over


def test_mixture(spark):
    random.seed(5)
    spread = [("a", 300), ("b", 200), ("é", 10), ("😀", 4), (None, 40), ("zero", 3)]
    rows = [(n, " ".join(["w"] * (0 if s == "zero" else random.randint(0, 40))), s) for n, s in enumerate(s for s, c in spread for _ in range(c))]
    rows += [(None, "x y", "a"), (5, rows[5][1], "a"), (9000, None, "b"), (9001, "v " * 50_000, "b")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], DOC + ", target int, size int")
    labels = spark.createDataFrame([(n, n % 2, 0) for n in range(0, 400, 3)] + [(3, 0, 0)], "doc_id long, quality int, toxic int")
    found = mix(docs, labels).collect()
    again = mix(docs.repartition(7), labels).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again)) and len(found) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    targets = brute_targets(sizes)
    by_source = {}
    for r in found:
        source = next(s for s, size in sizes.items() if size == r["source_size"] and abs(targets[s] - r["target"]) < 1e-6)
        by_source.setdefault(source, []).append(r)
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
    for source, taken in by_source.items():
        largest = max(r["size"] for r in taken)
        assert abs(sum(r["taken"] for r in taken) - targets[source]) <= largest / 2 + 1
    assert mix(docs.limit(0), labels).collect() == []
    assert mix(docs, None).count() == len(rows)


def test_mixture_in_many_blocks(spark, monkeypatch, folder):
    from corpusloom.llm import mixing

    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    whole = sorted(map(repr, mix(docs, labels).collect()))
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 2)
    assert sorted(map(repr, mix(docs, labels).collect())) == whole


def test_good_documents_come_first(spark):
    docs = spark.createDataFrame([(n, "w " * 10, "a" if n < 2000 else "b") for n in range(2400)], DOC)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    found = [r for r in mix(docs, labels).collect() if r["source_size"] == 20_000]
    good = sum(r["copies"] for r in found if r["doc_id"] % 2)
    assert good > 1.3 * sum(r["copies"] for r in found if not r["doc_id"] % 2)


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = []
    for rule in URL_RULES:
        name, prefix = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + prefix):
            fits.append(rule)
    return host, path, max(fits, key=len) if fits else None


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "https://example.com/en/1", "https://a.example.com/en/", "http://example.com",
    "http://example.com?q=/en/", "x://net/es/", "x://notnet/es/", "x://b.net/es/1", "x://b.net/es", "http://é.com/É", "a://b://c.com/", "http://u:p@h.com:80/p",
    "http://h.org/\nen/", "http://x.net/fr/" + "a" * 100_000,
]


def test_urls_against_brute_force(spark):
    pages = spark.createDataFrame([(n, u, 1) for n, u in enumerate([*URLS, URLS[5]])] + [(None, URLS[4], 1)], "page_id long, url string, host int")
    for r in judge_urls(pages, URL_RULES).collect():
        host, path, rule = brute_url([*URLS, URLS[5]][r["page_id"]] if r["page_id"] is not None else URLS[4])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (URL_RULES[rule] if rule else r["verdict"]) and r["verdict"] in ("allow", "block")
    assert judge_urls(pages.limit(0), URL_RULES).collect() == []


def test_url_rules_on_the_table(spark, folder):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = QUERIES["op4_url_filters"](spark, folder).collect()
    assert {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in found} == {n: brute_url(u) for n, u in urls.items()}
    assert all(r["verdict"] == URL_RULES[r["rule"]] for r in found if r["rule"])


def test_mined_rules_against_counts(spark):
    random.seed(4)
    rows = []
    for _ in range(400):
        tokens = sorted(random.sample(["a", "b", "c", "d"], k=random.randint(1, 3)))
        rows.append((tokens, "block" if {"a", "b"} <= set(tokens) or random.random() < 0.1 else "allow"))
    mined = mine_rules(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.02, 0.8)
    assert mined
    for tokens, verdict, confidence, support in mined:
        having = [v for t, v in rows if set(tokens) <= set(t)]
        assert confidence == pytest.approx(having.count(verdict) / len(having)) and confidence >= 0.8
        assert support == pytest.approx(having.count(verdict) / len(rows)) and support >= 0.02
    assert any(r[0] == ("a", "b") and r[1] == "block" for r in mined)


def brute_components(rows, size, threshold):
    sets = {}
    for n, (doc_id, text) in enumerate(rows):
        words = (text or "").encode().lower().split()
        sets[n] = {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
    root = {n: n for n in sets}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and rows[a][0] is not None and rows[b][0] is not None:
                both = len(sets[a] & sets[b])
                if 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                    root[find(a)] = find(b)
    least = {}
    for n in sets:
        least.setdefault(find(n), []).append(rows[n][0])
    return [(rows[n][0], len(sets[n]), None if rows[n][0] is None else min(i for i in least[find(n)] if i is not None)) for n in sets]


def edited(words, rng, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10_000)}"
    return words


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_against_brute_force(spark, size):
    rng = random.Random(size)
    rows, n = [], 0
    for group in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([6, 30, 120]))]
        for _ in range(rng.choice([1, 2, 8])):
            rows.append((n, " ".join(edited(base, rng, rng.randrange(4)))))
            n += 1
    chain = [f"c{k}" for k in range(100)]  # far ends alike only through the middle
    for _ in range(8):
        rows.append((n, " ".join(chain)))
        chain, n = chain[3:] + [f"c{n}-{k}" for k in range(3)], n + 1
    rows += [(n + 1, None), (n + 2, ""), (n + 3, " \t\n"), (n + 4, "one"), (n + 5, "ONE"), (n + 6, "É one"), (n + 7, "é one"), (None, rows[0][1])]
    rows += [(n + 8, " ".join(f"v{k}" for k in range(30_000))), (n + 9, " ".join(f"v{k}" for k in range(29_000))), rows[3]]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, digest string")
    found = near_duplicates(docs, shingle=size).collect()
    wanted = brute_components(rows, size, 80)
    assert sorted([tuple(r)[:3] for r in found], key=repr) == sorted(wanted, key=repr)
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in found)
    assert near_duplicates(docs.limit(0), shingle=size).collect() == []


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(3000)}" for _ in range(80)]
    rows = [(n, " ".join(edited(base, rng, rng.randrange(6)))) for n in range(150)]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()
    assert sorted(tuple(r)[:3] for r in found) == sorted(brute_components(rows, 2, 80))


def test_bands_meet_as_often_as_they_should():
    rng = np.random.default_rng(1)
    family = near_dedup.Bands(near_dedup.BANDS, near_dedup.DEPTH)
    met = 0
    for _ in range(300):
        both, left, right = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (160, 20, 20))  # similarity 0.8
        a, b = family.of(np.r_[both, left]), family.of(np.r_[both, right])
        same = a == b
        met += same[: near_dedup.BANDS].any() and same[near_dedup.BANDS :].any()
    assert met >= 299


def test_components_of_a_long_path_and_a_star(spark):
    path = [(n, n + 1) for n in range(0, 60)]
    star = [(100, n) for n in range(101, 160)]
    edges = spark.createDataFrame([*path, *star, (7, 7)], "x long, y long").repartition(5)
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    assert found == {n: 0 for n in range(61)} | {n: 100 for n in range(100, 160)}
    assert components(edges.limit(0)).collect() == []


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_against_sql(spark, folder, name):
    import duckdb

    connection = duckdb.connect()
    for table in ("documents", "embeddings", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    wanted = connection.sql(SQL[name])
    columns = sorted(wanted.columns)
    found = QUERIES[name](spark, folder).select(*columns)
    rows = wanted.select(*[f'"{c}"' for c in columns]).fetchall()
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, rows))


def test_queries_beside_small_lists_get_all_their_rows(spark, monkeypatch):
    from corpusloom.llm import approx_search

    monkeypatch.setattr(approx_search, "ROWS_PER_LIST", 50)
    draw = np.random.default_rng(9)
    rows = [(n, (draw.standard_normal(8) + 3).tolist()) for n in range(1, 600) if n % 100]
    # Queries far from all others, alone or with a few copies of one id.
    rows += [(100 * n, (np.eye(8)[n] * 1000 * n).tolist()) for n in range(1, 6)]
    rows += [(7, (np.eye(8)[2] * 2000 + 1 + n).tolist()) for n in range(15)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r["query_id"]: r["count"] for r in approx_search.nearest(vectors).groupBy("query_id").count().collect()}
    assert found == {100 * n: 10 for n in range(1, 6)}
    few = vectors.where("vec_id % 100 = 0")
    assert {r["count"] for r in approx_search.nearest(few).groupBy("query_id").count().collect()} == {4}
