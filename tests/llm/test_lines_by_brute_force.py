"""Line dedup against a plain version of its rule that holds everything in lists."""

import random
from collections import Counter, defaultdict

import pytest
import xxhash

from corpusloom.llm.line_dedup import drop_recurring
from corpusloom.llm.queries import QUERIES

ANY = "<*>"


def number(masked):
    value = xxhash.xxh3_64_intdigest(masked.encode())
    return value - (1 << 64) if value >> 63 else value


def mask(line):
    return " ".join(ANY if any(c.isdecimal() for c in word) else word for word in line.split())


def agreement(template, words):
    """Share of places that agree, unless half of the places or fewer agree in a fixed word."""
    fixed = [(t, w) for t, w in zip(template, words) if t != ANY]
    equal = sum(t == w for t, w in fixed)
    return (equal + len(template) - len(fixed)) / len(template) if 2 * equal > len(template) else 0.0


def one_pass(forms, agree):
    """Greedy grouping of [(name, words)]: [(name, template, names)]."""
    groups = []
    for name, words in forms:
        scores = [agreement(template, words) for _, template, _ in groups]
        best = max(range(len(scores)), key=lambda n: (scores[n], -n), default=None)
        if best is not None and scores[best] >= agree:
            first, template, names = groups[best]
            groups[best] = (first, [t if t == w else ANY for t, w in zip(template, words)], [*names, name])
        else:
            groups.append((name, list(words), [name]))
    return groups


def templates_of(masked_lines, agree):
    """Template (its first line) of every line of a leaf."""
    members = {line: [line] for line in masked_lines}
    forms = [(line, line.split(" ")) for line in sorted(masked_lines)]
    while True:
        groups = one_pass(forms, agree)
        members = {first: [line for name in names for line in members[name]] for first, _, names in groups}
        if len(groups) == len(forms):
            return {line: first for first, lines in members.items() for line in lines}
        forms = [(first, template) for first, template, _ in groups]


def brute(rows, min_documents=10, agree=0.7):
    """(doc_id, text) that stay."""
    held = defaultdict(Counter)  # document -> its lines; a document that is there twice counts them twice
    for doc, text in rows:
        held[doc].update({mask(line) for line in (text or "").split("\n") if line.split()})
    leaves = defaultdict(Counter)
    for lines in held.values():
        for line, times in lines.items():
            words = line.split(" ")
            leaves[len(words), *words[:2]][line] += times
    template = {}
    for lines in leaves.values():
        if sum(lines.values()) >= min_documents:
            of = templates_of(list(lines), agree)
            total = Counter()
            for line, times in lines.items():
                total[of[line]] += times
            template |= {line: first for line, first in of.items() if total[first] >= min_documents}
    marks = defaultdict(set)
    for doc, lines in held.items():
        own = [line for line in lines if line not in template]
        others = {number(template[line]) for line in lines if line in template}
        words = sum(len(line.split(" ")) * times for line, times in lines.items())
        for name in {template[line] for line in lines if line in template}:
            if 2 * sum(len(line.split(" ")) * lines[line] for line in own) >= words:
                mark = min(map(number, own), default=None)
            else:
                mark = min(others) if min(others) != number(name) else max(others)
            marks[name].add(mark)
    boilerplate = {name for name, seen in marks.items() if len(seen) >= min_documents}
    result = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        left = [line for line in lines if not line.split() or template.get(mask(line)) not in boilerplate]
        if len(left) == len(lines):
            result.append((doc, text))
        elif "\n".join(left).strip():
            result.append((doc, "\n".join(left)))
    return sorted(result, key=repr)


def test_table(spark, folder):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = [(r["doc_id"], r["text"]) for r in QUERIES["op2_line_dedup"](spark, folder).select("doc_id", "text").collect()]
    wanted = brute(docs)
    assert sorted(found, key=repr) == wanted
    assert wanted != sorted(docs, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_random_lines(spark, seed):
    """Few words, so that leaves are full of lines that nearly agree; odd rows, copies and repeated ids."""
    rng = random.Random(seed)
    shapes = [[rng.choice("abcdefgh") * 3 for _ in range(rng.randint(1, 9))] for _ in range(8)]

    def line():
        words = list(rng.choice(shapes))
        for n in range(len(words)):
            if rng.random() < 0.12:
                words[n] = rng.choice(["12", "x7", "é٣", f"w{rng.randrange(4)}x", rng.choice("ijkl") * 2])
        return rng.choice(["", " "]) + rng.choice([" ", "  ", "\t"]).join(words)

    def own():
        return " ".join("".join(rng.choices("mnopqrst", k=5)) for _ in range(rng.randint(2, 8)))

    rows = []
    for n in range(70):
        lines = [own() for _ in range(rng.randint(0, 4))] + [line() for _ in range(rng.randint(0, 4))]
        rng.shuffle(lines)
        rows.append((n, "\n".join(lines)))
    rows += [(100 + n, rows[n % 3][1]) for n in range(25)]
    rows += [(None, line()), (None, own()), (300, None), (301, ""), (302, " \n\t"), rows[4], (5, own())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for least, agree in ((10, 0.7), (4, 0.6)):
        found = sorted(((r["doc_id"], r["text"]) for r in drop_recurring(docs, least, agree).collect()), key=repr)
        assert found == brute(rows, least, agree)
