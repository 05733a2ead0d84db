"""Token counts, packing, language, line and unit deduplication against the libraries and brute force."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm.language_id import UNKNOWN, calibrate, identify
from corpusloom.llm.line_dedup import drop_recurring, parse, template_groups
from corpusloom.llm.packing import LocalSearch, best_fit, pack_documents
from corpusloom.llm.queries import CAPACITY, QUERIES, tokenizer_path
from corpusloom.llm.substring_dedup import LINE, PARAGRAPH, repeated_units
from corpusloom.llm.token_counts import BatchTokenizer, count_tokens, vocabulary_bytes

DOC = "doc_id long, text string"
ODD = "aaab  Àéßİσς中文٣½.,!?'s't<|endoftext|>😀‍#_\x1c\x85\u0308\n\t가"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    return BatchTokenizer(vocabulary_bytes(tokenizer_path()))


def test_every_code_point(library, tokenizer):
    """Beside letters, a digit and marks, for every code point."""
    texts = [f"a{c}b {c}1 ({c}\u0308" for c in map(chr, range(0x110000)) if not "\ud800" <= c <= "\udfff"]
    for at in range(0, len(texts), 50_000):
        part = texts[at : at + 50_000]
        wanted = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        found = [x.tolist() for x in tokenizer.encode(pa.array(part))]
        assert [p for p, a, b in zip(part, wanted, found) if a != b] == []
        assert tokenizer.count(pa.array(part)).tolist() == list(map(len, wanted))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(alphabet=ODD, max_size=40), st.text(max_size=30)), max_size=5))
def test_ids_are_those_of_the_library(library, tokenizer, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert [x.tolist() for x in tokenizer.encode(pa.array(texts, pa.string()))] == [ids_of(library, t) for t in texts]


@pytest.mark.parametrize("text", ["", "a" * 5000, "ab" * 4000, "no " * 30_000, "<|endoftext|>x<|startoftext|>", "aaa aa a aaaa"])
def test_long_and_repeating_texts(library, tokenizer, text):
    assert next(iter(tokenizer.encode(pa.array([text])))).tolist() == ids_of(library, text)


def test_token_counts(spark, library):
    rows = [(1, "Hello wörld"), (1, "Hello wörld"), (2, ""), (3, None), (None, "x" * 9000)]
    docs = spark.createDataFrame([(*r, "clash", 5) for r in rows], DOC + ", n_tokens string, n_bytes int")
    found = sorted(map(tuple, count_tokens(docs, tokenizer_path(), 2).collect()), key=repr)
    wanted = [(i, len((t or "").encode()), len(ids_of(library, t)), len(ids_of(library, t)) > 2) for i, t in rows]
    assert found == sorted(wanted, key=repr)
    assert count_tokens(docs.limit(0), tokenizer_path(), 2).collect() == []


def test_token_counts_of_the_table(spark, folder, library):
    rows = {r["doc_id"]: r for r in QUERIES["op3_token_counts"](spark, folder).collect()}
    for doc in spark.read.parquet(f"{folder}/documents.parquet").collect():
        count = len(ids_of(library, doc["text"]))
        assert rows[doc["doc_id"]][1:] == (len(doc["text"].encode()), count, count > CAPACITY)


def check_packing(pieces, texts, library, capacity):
    for doc_id, text in texts:
        own = sorted((r for r in pieces if r["doc_id"] == doc_id), key=lambda r: r["piece"])
        ids = ids_of(library, text) + [0]
        parts = [ids[a : a + capacity] for a in range(0, len(ids), capacity)]
        crcs = [zlib.crc32(np.array(p, "<u4").tobytes()) for p in parts]
        assert [(r["start"], r["length"], r["ids_crc32"]) for r in own] == [(n * capacity, len(p), c) for n, (p, c) in enumerate(zip(parts, crcs))]
    bins = {}
    for r in pieces:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        parts.sort()
        ends = np.cumsum([p[1] for p in parts])
        assert [p[0] for p in parts] == [0, *ends[:-1]] and ends[-1] <= capacity
    return len(bins)


def test_packing_of_the_table(spark, folder, library):
    pieces = QUERIES["op1_best_fit_packing"](spark, folder).collect()
    texts = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    used = check_packing(pieces, texts, library, CAPACITY)
    assert used <= -(-sum(r["length"] for r in pieces) // CAPACITY) + 1


def test_packing_of_odd_rows(spark, library):
    rows = [(1, None), (2, ""), (3, "word " * 300), (4, "a"), (5, "b")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], DOC + ", length int")
    assert check_packing(pack_documents(docs, tokenizer_path(), 64).collect(), rows, library, 64) == 5
    twice = docs.unionByName(docs).withColumn("doc_id", F.lit(None).cast("long"))
    packed = pack_documents(twice, tokenizer_path(), 64).collect()
    assert len(packed) == 2 * 9 and check_packing(packed, [], library, 64) == 10
    assert pack_documents(docs.limit(0), tokenizer_path(), 64).collect() == []


def test_packing_in_shards(spark, monkeypatch):
    from corpusloom.llm import packing

    monkeypatch.setattr(packing, "SHARD_PIECES", 50)
    random.seed(3)
    rows = [(n, 0, random.randint(1, 100)) for n in range(400)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, length long")
    packed = packing.pack(pieces, 100).collect()
    assert sorted(r["doc_id"] for r in packed) == list(range(400))
    used = check_packing(packed, [], None, 100)
    # Items as large as these do not fit well: without shards best fit alone needs 206 sequences of at least 199.
    assert used <= 1.05 * len(best_fit(np.array([r[2] for r in rows]), 100))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=60))
def test_local_search_keeps_every_item_and_never_needs_more_bins(sizes):
    sizes = np.array(sizes)
    start = best_fit(sizes, 50)
    search = LocalSearch(start, sizes, 50)
    bins = search.run()
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sizes[b].sum() <= 50 for b in bins) and len(bins) <= len(start)


def test_local_search_empties_a_bin():
    # 6+3 | 5+4 | 2 in bins of 10: only swaps bring the five items into two bins.
    sizes = np.array([6, 3, 5, 4, 2])
    assert len(LocalSearch([[0, 1], [2, 3], [4]], sizes, 10).run()) == 2


WORDS = {"en": "the of and to in is that for with".split(), "xx": "zor pli qua vex ujo wyk".split(), "de": "und der die über schön für nicht".split()}


def test_language_on_held_out_documents(spark):
    random.seed(1)
    rows = [(n, " ".join(random.choices(WORDS[lang], k=30)), lang) for n, lang in enumerate(random.choices(list(WORDS), k=300))]
    rows += [(1000, None, "en"), (1001, "", "en"), (1002, "12 34 !!", "de"), (1003, "the of " * 40_000, None), (None, "und der die", "de"), (0, *rows[0][1:])]
    docs = spark.createDataFrame([(*r, "s") for r in rows], DOC + ", lang string, label string")
    found = identify(docs, F.coalesce(F.col("doc_id") % 4 != 2, F.lit(False))).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    assert all(by_id[n]["lang_pred"] == UNKNOWN and by_id[n]["score"] == 0 for n in (1000, 1001, 1002))
    assert by_id[1003]["lang_pred"] == "en" and by_id[None]["lang_pred"] == "de"
    assert np.mean([by_id[r[0]]["lang_pred"] == r[2] for r in rows[:300] if r[0] % 4 == 2]) > 0.97
    assert {r["lang_pred"] for r in identify(docs, F.lit(False)).collect()} == {UNKNOWN}
    assert identify(docs.limit(0), F.lit(True)).collect() == []


def test_sample_of_a_language_is_bounded_and_never_empty(spark, monkeypatch):
    from corpusloom.llm import language_id

    monkeypatch.setattr(language_id, "SAMPLE_PER_LANGUAGE", 20)
    # One label with null ids only, one that is a single row over and over, one that is rare.
    rows = [(None, f"{clean_line(n)}", "aa") for n in range(2000)] + [(7, "und der die", "bb")] * 2000 + [(n, f"rare {n}", "cc") for n in range(3)]
    docs = spark.createDataFrame(rows, "id long, text string, label string").withColumn("draw", F.xxhash64("id", "text", F.lit(23)))
    different = {"aa": 2000, "bb": 1, "cc": 3}
    drawn = [tuple(r) for r in language_id.draw_sample(docs, different).collect()]
    by_label = {label: [r for r in drawn if r[2] == label] for label in different}
    assert {label: len(found) for label, found in by_label.items()} == {"aa": 20, "bb": 1, "cc": 3}
    assert len(set(drawn)) == len(drawn) and sorted(drawn, key=repr) == sorted(map(tuple, language_id.draw_sample(docs, different).collect()), key=repr)
    monkeypatch.setattr(language_id, "SAMPLE", 6)
    assert language_id.draw_sample(docs, different).groupBy("label").count().agg(F.max("count")).first()[0] == 2
    model = language_id.train(docs, "id", label_column="label")
    assert model.languages == ["aa", "bb", "cc"]


def test_language_of_the_table(spark, folder):
    found = QUERIES["op9_language_id"](spark, folder)
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert len(rows) == 200 and np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95


def test_temperature_lowers_overconfidence():
    sure_but_often_wrong = [np.array([8.0, 0.0])] * 10
    assert calibrate(sure_but_often_wrong, [0] * 6 + [1] * 4) > 5
    assert calibrate([], []) == 1.0


def test_template_groups_generalise_places():
    lines = ["user <*> logged in from home", "user <*> logged in from work", "disk full on node seven today"]
    assert template_groups([line.split() for line in lines], 0.7) == [0, 0, 2]
    assert parse("  \t ") is None and parse("page 12 of 30")[1] == parse("page 7 of 99")[1]


def clean_line(n):
    rng = random.Random(n)
    return " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(12))


def test_recurring_templates_are_dropped_and_copies_are_not(spark):
    rows = [(n, f"{clean_line(n)}\nVisit us again, page {n} of 99\n{clean_line(n + 500)}") for n in range(20)]
    copy = "\n".join(clean_line(k) for k in range(900, 906))
    rows += [(100 + n, copy) for n in range(30)]  # the same lines with the same neighbours
    rows += [(200, None), (201, ""), (202, "Visit us again, page 5 of 99"), (203, "Visit us again, page 6 of 99"), (None, clean_line(7000)), (0, rows[0][1])]
    docs = spark.createDataFrame([(*r, "src", 1) for r in rows], DOC + ", _gone string, line int")
    kept = drop_recurring(docs)
    assert kept.schema == docs.schema
    found = sorted(map(tuple, kept.collect()), key=repr)
    wanted = [(n, f"{clean_line(n)}\n{clean_line(n + 500)}") for n in [*range(20), 0]] + [(100 + n, copy) for n in range(30)]
    wanted += [(200, None), (201, ""), (None, clean_line(7000))]
    assert found == sorted([(*w, "src", 1) for w in wanted], key=repr)
    assert drop_recurring(docs.limit(0)).collect() == []


def test_boilerplate_is_judged_by_different_documents(spark):
    block = ["Subscribe to our letter", "Read on every device you own", "Follow us on all the networks"]
    own = lambda n: [clean_line(10_000 + 10 * n + k) for k in range(4)]
    header = "All of this is free to copy"
    rows = [(n, [header, *own(n)] if n % 2 else [*own(n), header]) for n in range(40)]
    rows += [(100 + n, [*block, *own(100 + n)]) for n in range(20)]
    inside = "Printed on paper from our own mill"
    copy = own(500) + [inside] + own(501)
    rows += [(200 + n, copy) for n in range(50)]
    rows += [(300 + n, [*own(300 + n)[:2], inside, *own(300 + n)[2:]]) for n in range(12)]
    long = [clean_line(20_000 + k) for k in range(10)]
    near = [(400 + n, [*long[: n % 10], clean_line(30_000 + n), *long[n % 10 + 1 :]]) for n in range(40)]
    docs = spark.createDataFrame([(n, "\n".join(t)) for n, t in rows + near], DOC)
    gone = {header, inside, *block}
    kept = {r["doc_id"]: r["text"].split("\n") for r in drop_recurring(docs).collect()}
    assert kept == {n: [x for x in t if x not in gone] for n, t in rows + near}


def test_long_lines_share_templates(spark):
    words = " ".join(clean_line(40_000 + k) for k in range(8)).split()
    notice = lambda n: " ".join([*words[:30], clean_line(41_000 + n).split()[0], *words[30:]])
    rows = [(n, "\n".join([*(clean_line(42_000 + 20 * n + k) for k in range(12)), notice(n)])) for n in range(20)]
    kept = drop_recurring(spark.createDataFrame(rows, DOC)).collect()
    assert len(notice(0).split()) == 97 and len(kept) == 20
    assert {r["doc_id"]: r["text"] for r in kept} == {n: t.rpartition("\n")[0] for n, t in rows}


def test_crowded_leaves_give_the_templates_of_small_ones(spark, monkeypatch):
    from corpusloom.llm import line_dedup

    name = lambda n: clean_line(50_000 + n).split()[0]
    third = lambda n: f"Written by {name(n)} for all of the readers here"
    late = lambda n: f"This work is licensed to {name(n)} under the usual terms"
    rows = [(n, [third(n), *(clean_line(52_000 + 10 * n + k) for k in range(6)), late(n)]) for n in range(40)]
    # A leaf of its own, in which no line is like another.
    rows += [(100 + n, [f"We say {clean_line(60_000 + n)}", *(clean_line(62_000 + 10 * n + k) for k in range(3))]) for n in range(20)]
    docs = spark.createDataFrame([(n, "\n".join(t)) for n, t in rows], DOC)
    wanted = {n: t[1:-1] if n < 100 else t for n, t in rows}
    for most in (4096, 9):
        monkeypatch.setattr(line_dedup, "LEAF_LINES", most)
        assert {r["doc_id"]: r["text"].split("\n") for r in drop_recurring(docs).collect()} == wanted


def test_a_very_long_document_passes_line_dedup(spark):
    text = "\n".join(clean_line(n) for n in range(4000))
    assert drop_recurring(spark.createDataFrame([(1, text)], DOC)).collect()[0]["text"] == text


def word_list(text):
    return [w.lower() for w in re.findall(r"[^\W_]+", text or "")]


def windows(words, n):
    return {tuple(words[at : at + n]) for at in range(len(words) - n + 1)}


def wrapped(words, rng):
    """The same words, wrapped and punctuated in another way."""
    return "".join(w.capitalize() + rng.choice([" ", " ", "  ", "\n", ", "]) for w in words)


def test_passages_by_their_words(spark):
    """Held against the words alone: shared passages of over 50 words go but once, however wrapped; documents that share none keep all."""
    rng = random.Random(3)
    fresh_words = lambda n: ["".join(rng.choices("bcdfgaeiou", k=6)) for _ in range(n)]
    prose = lambda n: ". ".join(" ".join(fresh_words(rng.randint(3, 18))) for _ in range(n)) + ". "
    passages = [fresh_words(70) for _ in range(8)] + [word_list(prose(9)) for _ in range(8)]
    short = " ".join(fresh_words(9)) + ". "
    opener = next(w for w in fresh_words(200) if zlib.crc32(w.encode()) % 8 == 0)
    rows = []
    for n in range(160):
        body = [prose(6), short, prose(5)]
        if n % 2 == 0:
            body.insert(rng.choice([0, 1, 2, 3]), wrapped(rng.choice(passages), rng) + ". ")
        rows.append((n, "".join(body)))
    rows += [(300, ""), (301, None), (None, wrapped(passages[0], rng)), (302, f"{opener} " * 400), (5, rows[5][1]), (5, rows[4][1]), (None, None)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], DOC + ", digest string, start int").repartition(4)
    found = repeated_units(docs).collect()
    assert len(found) == len(rows)
    texts, left = {}, {}
    for doc_id, text in rows:
        texts.setdefault(doc_id, []).append(text)
    missed = caught = 0
    for r in found:
        original = next(t for t in texts[r["doc_id"]] if (t is None) == (r["text"] is None) and len(t or "") == len(r["text"] or "") + r["removed_chars"])
        assert r["text"] is None or "".join(original[s["start"] : s["end"]] for s in r["spans"]) == r["text"]
        assert r["n_removed"] == 0 or r["removed_chars"] > 0
        left.setdefault(r["doc_id"], []).append(r)
    for n in range(160):
        shares = any(windows(word_list(rows[n][1]), 50) & windows(word_list(other), 50) for i, other in rows if i != n and other)
        lost = left[n][0]["removed_chars"] if n != 5 else 0
        assert shares or lost == 0
    # Every passage is left once; what is left of a copy is less than a unit at either end.
    for passage in passages:
        holders = [n for n, text in rows if text and windows(passage, 50) & windows(word_list(text), 50)]
        still = [n for n in set(holders) if any(windows(passage, 50) & windows(word_list(r["text"]), 50) for r in left[n])]
        caught, missed = caught + len(set(holders)) - len(still), missed + max(0, len(still) - 1)
        assert not holders or len(still) >= 1
    assert caught > 40 and missed <= 2
    # A text that repeats itself keeps its first run; a word that opens units is needed for that.
    assert [len(word_list(r["text"])) for r in left[302]] == [30]
    assert repeated_units(docs.limit(0)).collect() == []


def test_lines_as_units(spark):
    block = clean_line(1) + "\n" + clean_line(2)
    docs = spark.createDataFrame([(1, f"intro\n{block}\nend"), (2, f"{block}\nother"), (3, clean_line(2))], DOC)
    found = {r["doc_id"]: r["text"] for r in repeated_units(docs, separator=LINE, min_words=len(word_list(clean_line(2))), longest=None).collect()}
    assert found == {1: f"intro\n{block}\nend", 2: "other", 3: ""}


def test_paragraph_units(spark):
    block = clean_line(1) + "\n" + clean_line(2)
    docs = spark.createDataFrame([(1, f"intro\n\n{block}\n\nend"), (2, f"{block}\n\nother")], DOC)
    found = {r["doc_id"]: r["text"] for r in repeated_units(docs, separator=PARAGRAPH, min_words=8, longest=None).collect()}
    assert found == {1: f"intro\n\n{block}\n\nend", 2: "other"}
