"""Line deduplication with a log-template tree.

A line's way through the tree is fixed: its number of tokens, then its leading tokens. Tokens with a digit are variable from
the start; within a leaf, lines that agree in most places share a template whose other places are variable.
Templates that recur in many documents are boilerplate, and their lines are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.common import fresh, stored

VARIABLE = "<*>"
_DIGIT = re.compile(r"\d")
# Leading tokens that lead through the tree.
DEPTH = 2
# Different lines of a leaf, and tokens in them, that are clustered at once; blocks of a larger leaf are merged afterwards.
LEAF_LINES, LEAF_TOKENS = 4096, 1 << 22


def parse(line: str) -> tuple[int, int, str, int] | None:
    """Leaf, hash of the masked line, masked line and token count; None for a line without tokens."""
    tokens = line.split()
    if not tokens:
        return None
    if _DIGIT.search(line):
        tokens = [VARIABLE if _DIGIT.search(t) else t for t in tokens]
    masked = " ".join(tokens)
    leaf = xxhash.xxh3_64_intdigest("\x1f".join([str(len(tokens)), *tokens[:DEPTH]]).encode("utf-8", "surrogatepass"))
    return leaf, xxhash.xxh3_64_intdigest(masked.encode("utf-8", "surrogatepass")), masked, len(tokens)


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())


def _table(lines: list[list[str]]) -> np.ndarray:
    codes: dict[str, int] = {VARIABLE: 0}
    return np.array([[codes.setdefault(t, len(codes)) for t in line] for line in lines], np.int32)


def _agreement(known: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The share of places in which each of the known templates agrees with a line; 0 where too few would stay fixed."""
    fixed = known != 0
    equal = ((known == row) & fixed).sum(axis=1)
    score = (equal + (~fixed).sum(axis=1)) / known.shape[1]
    score[equal * 2 <= known.shape[1]] = 0
    return score


def template_groups(lines: list[list[str]], agree: float) -> list[int]:
    """For lines of one token count: the number of the first line of each one's template.

    A line joins the template that it agrees with in most places (variable places agree with anything), if that is a
    share of at least ``agree`` and over half of its places are still fixed; places that differ become variable.
    """
    return _grouped(lines, agree)[0]


def _grouped(lines: list[list[str]], agree: float) -> tuple[list[int], dict[int, list[str]]]:
    """The groups of :func:`template_groups`, and the template of each first line."""
    table = _table(lines)
    templates = np.zeros_like(table)
    owners: list[int] = []
    result = []
    for n, row in enumerate(table):
        if owners:
            score = _agreement(templates[: len(owners)], row)
            best = int(score.argmax())
            if score[best] >= agree:
                templates[best][templates[best] != row] = 0
                result.append(owners[best])
                continue
        templates[len(owners)] = row
        owners.append(n)
        result.append(n)
    return result, {n: [t if code else VARIABLE for t, code in zip(lines[n], templates[k])] for k, n in enumerate(owners)}


def settled_groups(lines: list[list[str]], agree: float) -> tuple[list[int], dict[int, list[str]]]:
    """Groups as in :func:`template_groups`, their templates grouped again until none agrees enough with an earlier one."""
    groups, forms = _grouped(lines, agree)
    while True:
        firsts = list(forms)
        again, merged = _grouped([forms[n] for n in firsts], agree)
        if len(merged) == len(firsts):
            return groups, forms
        into = {n: firsts[m] for n, m in zip(firsts, again)}
        groups, forms = [into[n] for n in groups], {firsts[n]: form for n, form in merged.items()}


def _in_blocks(rows: DataFrame, key: str) -> DataFrame:
    """Adds the number of blocks of each leaf, and a block by a hash of ``key``."""
    sizes = rows.groupBy("leaf").agg(F.greatest(F.ceil(F.count(F.lit(1)) / LEAF_LINES), F.ceil(F.sum("words") / LEAF_TOKENS)).cast("int").alias("blocks"))
    return rows.join(sizes, "leaf").withColumn("block", F.pmod(F.xxhash64(key), F.col("blocks")).cast("int"))


def _merged(templates: DataFrame, agree: float) -> DataFrame:
    """Templates of leaves in several blocks that agree enough with others: ``template``, ``into``.

    In every round each block of a leaf meets each block in a task of its own, where a template looks for an earlier one that it
    agrees with. Those whose earlier one has none itself join it. Ends when no template finds another; leaves without a
    find leave the rounds before.
    """

    def look(table: pa.Table) -> pa.Table:
        table = table.sort_by("template")
        names, block = table.column("template").to_numpy(), table.column("block").to_numpy()
        forms = _table([m.split(" ") for m in table.column("masked").to_pylist()])
        apart, found, into = block.min() != block.max(), [], []
        for n in range(1, len(forms)):
            score = _agreement(forms[:n], forms[n])
            if apart:
                score[block[:n] == block[n]] = 0
            best = int(score.argmax())
            if score[best] >= agree:
                found.append(names[n])
                into.append(names[best])
        return pa.table([table.column("leaf").take(pa.array([0] * len(found), pa.int64())), pa.array(found, pa.int64()), pa.array(into, pa.int64())], ["leaf", "template", "into"])

    def join(table: pa.Table) -> pa.Table:
        # The root is the least of its own members.
        table = table.sort_by("template")
        groups, forms = _grouped([m.split(" ") for m in table.column("masked").to_pylist()], agree)
        of_root = pa.array([g == 0 for g in groups], pa.bool_())
        own = table.select(["template", "into"]).filter(of_root)
        return own.append_column("form", pa.array([" ".join(forms[0])] * own.num_rows, pa.string()))

    moves: list[DataFrame] = []
    live = templates
    while True:
        dealt = _in_blocks(live, "template")
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("_other")
        pairs = dealt.select("leaf", "template", "masked", "block", other)
        pairs = pairs.select("leaf", F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"), "template", "masked", "block")
        found = pairs.groupBy("leaf", "low", "high").applyInArrow(look, "leaf long, template long, into long")
        found = stored(found.groupBy("leaf", "template").agg(F.min("into").alias("into")))
        if found.isEmpty():
            break
        ready = found.join(found.select(F.col("template").alias("into")), "into", "left_anti").select("template", "into")
        ready = ready.union(ready.select(F.col("into").alias("template"), "into").distinct())
        moved = stored(ready.join(live.select("template", "masked"), "template").groupBy("into").applyInArrow(join, "template long, into long, form string"))
        moves.append(moved.where("template <> into").select("template", "into"))
        live = live.join(found.select("leaf").distinct(), "leaf", "left_semi")
        live = live.join(moves[-1], "template", "left_anti").join(moved.where("template = into").select("template", "form"), "template", "left")
        live = stored(live.select("leaf", "template", F.coalesce("form", "masked").alias("masked"), "words"))
    result = templates.select("template", F.col("template").alias("into"))
    for move in moves:
        result = result.join(move.select(F.col("template").alias("into"), F.col("into").alias("_next")), "into", "left")
        result = result.select("template", F.coalesce("_next", "into").alias("into"))
    return result.where("template <> into")


def recurring_lines(
    docs: DataFrame, min_documents: int = 10, agree: float = 0.7, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Lines of recurring templates: id, ``line`` (hash of the masked line).

    A template recurs if it stands in at least ``min_documents`` different documents, wherever it stands in them. Copies count
    once: a document is known by the least hash of its own lines, those whose template has fewer than ``min_documents``
    lines. Where these are less than half of its words it is a copy but for some edits, and is known by the least of its other
    templates. So copies of whole documents are not boilerplate, and boilerplate within copies is judged by the other documents.
    Documents are told apart by id; null ids count as one. Stores the parsed lines and the distinct lines of leaves with enough lines, both
    without text, and the templates. Texts are parsed again for the lines that are compared.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "leaf", "line", "words"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, leaf, code, words = [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                parsed = [p for p in map(parse, text.split("\n")) if p] if text else []
                seen = set()
                for own, line, _, count in parsed:
                    if line in seen:
                        continue
                    seen.add(line)
                    of.append(row)
                    leaf.append(own)
                    code.append(line)
                    words.append(count)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(of, pa.int64())), *map(_signed, (leaf, code)), pa.array(words, pa.int32())], names
            )

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = {p[1]: p[2] for text in batch.column(0).to_pylist() if text for p in map(parse, text.split("\n")) if p}
            yield pa.RecordBatch.from_arrays([_signed(list(forms)), pa.array(forms.values(), pa.string())], ["line", "masked"])

    lines = stored(rows.mapInArrow(read, f"doc_id {kind}, leaf long, line long, words int"))
    crowded = stored(lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_documents).select("leaf"))
    counted = lines.groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("n"), F.min("words").alias("words"))
    distinct = stored(counted.join(crowded, "leaf"))
    # Templates of several lines, leaf by leaf; only here lines carry their text.
    sizes = distinct.groupBy("leaf").agg(F.count(F.lit(1)).alias("_lines")).where("_lines > 1")
    forms = rows.select("text").mapInArrow(spell, "line long, masked string").groupBy("line").agg(F.min("masked").alias("masked"))
    several = _in_blocks(distinct.join(sizes, "leaf").select("leaf", "line", "words"), "line").join(forms, "line")
    several = several.select("leaf", "block", "blocks", "line", "masked")

    def cluster(table: pa.Table) -> pa.Table:
        table = table.sort_by("masked")
        code = table.column("line").to_numpy()
        groups, found = settled_groups([m.split(" ") for m in table.column("masked").to_pylist()], agree)
        # Templates go on where their leaf has other blocks.
        first = [n == g and blocks > 1 for n, (g, blocks) in enumerate(zip(groups, table.column("blocks").to_pylist()))]
        form = pa.array([" ".join(found[n]) if own else None for n, own in enumerate(first)], pa.string())
        words = pa.array([len(m.split(" ")) for m in table.column("masked").to_pylist()], pa.int32())
        result = pa.table([table.column("leaf"), pa.array(code), pa.array(code[groups]), form, words], ["leaf", "line", "template", "form", "words"])
        return result.filter(pa.array([a or g != n for n, (g, a) in enumerate(zip(groups, first))], pa.bool_()))

    clustered = stored(several.groupBy("leaf", "block").applyInArrow(cluster, "leaf long, line long, template long, form string, words int"))
    joined = clustered.where("line <> template").select("line", "template")
    halves = clustered.where("form is not null").select("leaf", "template", F.col("form").alias("masked"), "words")
    if not halves.isEmpty():
        merged = stored(_merged(halves, agree))
        joined = clustered.select("line", "template").join(merged, "template", "left")
        joined = joined.select("line", F.coalesce("into", "template").alias("template")).where("line <> template")
    templates = distinct.select("line", "n").join(joined, "line", "left").select("line", F.coalesce("template", "line").alias("template"), "n")
    templates = stored(templates)
    often = templates.groupBy("template").agg(F.sum("n").alias("_n")).where(F.col("_n") >= min_documents).select("template")
    wanted = stored(templates.join(often, "template").select("line", "template"))
    own = F.col("template").isNull()
    known = lines.select("doc_id", "line", "words").join(wanted, "line", "left").groupBy(F.col("doc_id").alias("_of")).agg(
        F.sum("words").alias("_words"), F.sum(F.when(own, F.col("words")).otherwise(0)).alias("_own"),
        F.min(F.when(own, F.col("line"))).alias("_own_line"), F.min("template").alias("_least"), F.max("template").alias("_most"),
    )
    other = F.when(F.col("_least") == F.col("template"), F.col("_most")).otherwise(F.col("_least"))
    mark = F.when(F.col("_own") * 2 >= F.col("_words"), F.col("_own_line")).otherwise(other)
    places = lines.select("doc_id", "line").join(wanted, "line")
    marked = places.select("template", "doc_id").distinct().join(known, F.col("doc_id").eqNullSafe(F.col("_of")))
    found = marked.select("template", mark.alias("_mark")).distinct().groupBy("template").agg(F.count(F.lit(1)).alias("_documents"))
    found = stored(found.where(F.col("_documents") >= min_documents).select("template").join(wanted, "template").select("line"))
    return places.select("doc_id", "line").join(found, "line").select(F.col("doc_id").alias(id_column), "line").distinct()


def drop_recurring(docs: DataFrame, min_documents: int = 10, agree: float = 0.7, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the lines of recurring templates (see :func:`recurring_lines`); all its columns stay.

    A document of which nothing but white space is left, and had something before, goes; null and empty texts stay as they
    are. Rows that repeat an id lose the same lines; null ids count as one document. Other columns are not touched.
    """
    gone_column, key = fresh(docs, "_gone"), fresh(docs, "_loser")
    losers = recurring_lines(docs, min_documents, agree, id_column, text_column)
    losers = losers.groupBy(F.col(id_column).alias(key)).agg(F.collect_set("line").alias(gone_column))
    joined = docs.join(losers, F.col(id_column).eqNullSafe(F.col(key)), "left").drop(key)
    place, gone_place = docs.columns.index(text_column), len(docs.columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, stay = [], []
            for text, gone in zip(batch.column(place).to_pylist(), batch.column(gone_place).to_pylist()):
                kept = text
                if gone:
                    gone = set(gone)
                    kept = "\n".join([x for x in text.split("\n") if not ((p := parse(x)) and int(np.uint64(p[1]).view(np.int64)) in gone)])
                texts.append(kept)
                stay.append(not gone or bool(kept.strip()))
            columns = list(batch.columns[:gone_place])
            columns[place] = pa.array(texts, columns[place].type)
            result = pa.RecordBatch.from_arrays(columns, schema=pa.schema([batch.schema.field(n) for n in range(gone_place)]))
            yield result.filter(pa.array(stay, pa.bool_()))

    return joined.mapInArrow(cut, docs.schema)
