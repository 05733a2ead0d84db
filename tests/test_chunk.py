import re

import pytest
from hypothesis import given, settings, strategies as st

from corpusloom.operators.chunk import chunk_documents, fixed_spans, register_chunk_text, sentence_spans

TEXT = st.text(alphabet=st.sampled_from(list("ab .!?\n\tÄé😀é ")), max_size=400)
SHAPES = st.tuples(st.integers(2, 60), st.integers(0, 59), st.integers(0, 20)).filter(lambda t: t[1] < t[0])


@settings(max_examples=400, deadline=None)
@given(TEXT, SHAPES)
def test_fixed_chunks(text, shape):
    size, overlap, least = shape
    body = text.strip()
    spans = fixed_spans(text, size, overlap, least)
    if len(body) < least:
        assert spans == []
    starts = [s for s, _, _ in spans]
    assert starts == sorted(set(starts))
    for start, end, piece in spans:
        assert 0 < end - start <= size or body == ""
        assert piece == body[start:end].strip() and len(piece) >= least
        if end < len(body) and end - start < size:
            # Ended early: at the last space of the window, beyond its middle.
            assert body[end] == " " and end > start + size // 2
            assert " " not in body[end + 1 : start + size]
        elif end < len(body):
            assert " " not in body[start + size // 2 + 1 : end]


@settings(max_examples=300, deadline=None)
@given(TEXT, SHAPES)
def test_fixed_chunks_leave_only_a_short_tail(text, shape):
    size, overlap, _ = shape
    body = text.strip()
    spans = fixed_spans(text, size, overlap, 0)
    covered = set()
    for start, end, _ in spans:
        covered.update(range(start, end))
    missing = [i for i in range(len(body)) if i not in covered]
    assert not missing or missing == list(range(missing[0], len(body)))
    assert len(missing) == 0


def runs(lengths, size, overlap):
    """Sentence ranges by their definition, every quantity computed from scratch."""
    first = new = 0

    def joined(low, high):
        return sum(lengths[low:high]) + max(high - low - 1, 0)

    while True:
        full = [
            k for k in range(first + 1, len(lengths))
            if k >= new and joined(first, new) + sum(n + 1 for n in lengths[new:k]) + lengths[k] > size
        ]
        stop = min(full, default=len(lengths))
        yield first, stop
        if not full:
            return
        fits = [low for low in range(first, stop + 1)
                if all(joined(i + 1, stop) + lengths[i] < overlap for i in range(low, stop))]
        first, new = min(fits), stop


@settings(max_examples=400, deadline=None)
@given(TEXT, SHAPES)
def test_sentence_chunks(text, shape):
    size, overlap, least = shape
    sentences = re.split(r"(?<=[.!?])\s+", text)
    spans = sentence_spans(text, size, overlap, least)
    expected, start, before = [], 0, None
    for first, stop in runs([len(x) for x in sentences], size, overlap):
        piece = " ".join(sentences[first:stop])
        if before is not None:
            shared = " ".join(sentences[first : before[1]])
            start += len(before[2]) - len(shared)
        before = (first, stop, piece)
        if stop < len(sentences) or len(piece) >= least:
            expected.append((start, start + len(piece), piece))
    assert spans == expected


def grid(text, size, overlap, least):
    step, i, rows = size - overlap, 0, []
    while i == 0 or i * step < len(text):
        piece = text[i * step : i * step + size]
        if len(piece) > least:
            rows.append((i, piece))
        i += 1
    return rows


def window(text, size, overlap):
    rows, start = [], 0
    while start < len(text):
        rows.append((len(rows), text[start : start + size]))
        if start + size >= len(text):
            break
        start += size - overlap
    return rows


@pytest.mark.parametrize("size,overlap,least", [(10, 2, 3), (10, 0, 0), (10, 7, 2), (5, 4, 0), (7, 3, 50)])
def test_grid_and_window(spark, size, overlap, least):
    base = "ab😀 cdé fgh.\n" * 9
    texts = ["", "a", None] + [base[:n] for n in list(range(2, 30)) + [99, 100, 101]]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, content string")
    for strategy, rule in (("grid", lambda t: grid(t, size, overlap, least)), ("window", lambda t: window(t, size, overlap))):
        rows = chunk_documents(docs, strategy, size, overlap, least).collect()
        found = sorted((int(r.doc_id), r.chunk_index, r.chunk_content) for r in rows)
        wanted = sorted((i, n, piece) for i, t in enumerate(texts) if t is not None for n, piece in rule(t))
        assert found == wanted
        for r in rows:
            assert texts[int(r.doc_id)][r.start_char : r.end_char] == r.chunk_content
            assert r.chunk_length == len(r.chunk_content)
            assert r.chunk_id == f"{r.doc_id}_{r.chunk_index}"


def test_text_dependent_chunks_on_spark(spark):
    texts = ["One. Two! " * 40, None, "", " short ", "word " * 100]
    docs = spark.createDataFrame([(i, t, "MIT") for i, t in enumerate(texts)], "id long, content string, license string")
    for strategy, rule in (("fixed", fixed_spans), ("sentence", sentence_spans)):
        rows = chunk_documents(docs, strategy, 60, 15, 10, keep=("license",)).collect()
        found = {(int(r.doc_id), r.chunk_index, r.start_char, r.end_char, r.chunk_content, r.license) for r in rows}
        wanted = {
            (i, n, start, end, piece, "MIT")
            for i, t in enumerate(texts) if t is not None for n, (start, end, piece) in enumerate(rule(t, 60, 15, 10))
        }
        assert found == wanted


def test_defaults_end_on_long_text():
    spans = fixed_spans("word " * 2000, 1000, 200, 50)
    assert spans[-1][1] == len(("word " * 2000).strip())


def test_bad_parameters(spark):
    docs = spark.createDataFrame([("a", "b")], "id string, content string")
    with pytest.raises(ValueError):
        chunk_documents(docs, "fixed", 100, 100)
    with pytest.raises(ValueError):
        chunk_documents(docs, "semantic")


def test_lateral_function(spark):
    register_chunk_text(spark)
    for text in ("", "a" * 10, "abcdefghij" * 3 + "k"):
        rows = spark.sql("SELECT c.* FROM (SELECT {t} AS t), LATERAL chunk_text(t, 10, 3) c", t=text).collect()
        assert [(r.chunk_index, r.chunk_content) for r in rows] == window(text, 10, 3)
