"""Token counts by merging whole batches of pre-tokens at once.

Arrow cuts the texts of a batch at ASCII white space, which no pre-token of the tokenizer crosses, and numbers the different
chunks. Every new chunk is cut into pre-tokens, all of these lie in one ragged array of symbols, and each pass merges in every
sequence its pair of lowest rank. What has been merged once is remembered, within a bound, for the rest of the task: its ids lie
in one flat array, from which the ids of whole texts are taken at once.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

# Chunks a task remembers before it starts anew, and their bytes; bytes of text that are looked up at a time. Memory only.
REMEMBERED, REMEMBERED_BYTES, AT_ONCE = 750_000, 32 << 20, 8 << 20
# Below this code point every Unicode version agrees on classes, composition and lower case.
_SETTLED = 0x250


class MergeTable:
    """Pre-token rules and ranked merges of a byte-level BPE file with word ends, ready for NumPy."""

    def __init__(self, raw: bytes) -> None:
        import regex
        from tokenizers import Tokenizer

        spec = json.loads(raw)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("ignore_merges") or model.get("byte_fallback"):
            raise ValueError("only byte-level BPE files with word ends are supported")
        library = Tokenizer.from_str(raw.decode())
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        rules = spec["pre_tokenizer"]["pretokenizers"][0]
        self.pattern = regex.compile(rules["pattern"]["Regex"])
        self.odd, self.quick = _quick_patterns(rules["pattern"]["Regex"])
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = {k: np.array([v], np.uint32).tobytes() for k, v in specials.items()}
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(specials, key=len, reverse=True))) + ")")
        vocabulary, end = model["vocab"], model.get("end_of_word_suffix") or ""
        self.letter_bytes = {c: b for b, c in enumerate(_byte_letters())}
        letters = _byte_letters()
        self.inner = np.array([vocabulary[c] for c in letters], np.int64)
        self.last = np.array([vocabulary[c + end] for c in letters], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.width = max(vocabulary.values()) + 1
        keys = np.array([vocabulary[a] * self.width + vocabulary[b] for a, b in pairs], np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self.made = made
        self._place(keys)
        # A pair may be merged everywhere in a sequence at once if nothing made by it takes part in an earlier merge.
        earliest = np.full(self.width, len(pairs), np.int64)
        for rank in range(len(pairs) - 1, -1, -1):
            earliest[vocabulary[pairs[rank][0]]] = earliest[vocabulary[pairs[rank][1]]] = rank
        self.at_once = earliest[made] > np.arange(len(pairs))

    def _place(self, keys: np.ndarray) -> None:
        """An open hash table of the pairs: a lookup is a few array reads."""
        self.slot_keys = np.full(1 << 20, -1, np.int64)
        self.slot_ranks = np.full(1 << 20, len(keys), np.int64)
        left, self.probes = np.arange(len(keys)), 0
        while len(left):
            at = (_slots(keys[left]) + self.probes) & 0xFFFFF
            free = self.slot_keys[at] < 0
            self.slot_keys[at[free]] = keys[left[free]]
            placed = self.slot_keys[at] == keys[left]
            self.slot_ranks[at[placed]] = left[placed]
            left, self.probes = left[~placed], self.probes + 1

    def rank(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols; the number of merges where there is none."""
        keys = first * self.width + second
        at = _slots(keys)
        held = self.slot_keys[at]
        ranks = np.where(held == keys, self.slot_ranks[at], len(self.made))
        # The table is nearly empty, so few look-ups meet another pair in their place and have to go on.
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        for probe in range(1, self.probes):
            if not len(open_):
                break
            more = (at[open_] + probe) & 0xFFFFF
            held = self.slot_keys[more]
            hit = held == keys[open_]
            ranks[open_[hit]] = self.slot_ranks[more[hit]]
            open_ = open_[~hit & (held >= 0)]
        return ranks

    def pieces(self, chunk: str) -> list[bytes]:
        """Pre-tokens of any chunk without special strings, as bytes: by the library's own normalizer and splitter."""
        split = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(chunk))
        return [bytes(map(self.letter_bytes.__getitem__, piece)) for piece, _ in split]

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all pieces (none empty), one after the other, and how many each has."""
        if not pieces:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        symbols, ends = self.inner[raw], np.cumsum(sizes) - 1
        symbols[ends] = self.last[raw[ends]]
        owner, none = np.repeat(np.arange(len(pieces)), sizes), len(self.made)
        rank = np.full(len(symbols), none, np.int64)  # of each symbol with the next of its sequence
        if len(symbols) > 1:
            rank[:-1] = np.where(owner[1:] == owner[:-1], self.rank(symbols[:-1], symbols[1:]), none)
        done_symbols, done_owner = [], []
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(symbols)]))
            going = best < none
            if not going.all():
                done_symbols.append(symbols[~going])
                done_owner.append(owner[~going])
                symbols, owner, rank, best = symbols[going], owner[going], rank[going], best[going]
                if not len(symbols):
                    break
            chosen = np.flatnonzero(rank == best)
            leads = np.r_[True, owner[chosen[1:]] != owner[chosen[:-1]]]
            # Of overlapping places of one pair every second counts, from the left; of an unsafe pair only the first.
            first = np.flatnonzero(leads | np.r_[True, chosen[1:] != chosen[:-1] + 1])
            place = np.arange(len(chosen)) - np.repeat(first, np.diff(np.r_[first, len(chosen)]))
            chosen = chosen[(place % 2 == 0) & (self.at_once[best[chosen]] | leads)]
            symbols[chosen] = self.made[rank[chosen]]
            rest = np.ones(len(symbols), bool)
            rest[chosen + 1] = False
            rank[chosen] = -1  # to be looked up anew, as is the symbol before each
            symbols, owner, rank = symbols[rest], owner[rest], rank[rest]
            at = np.flatnonzero(rank < 0)
            at = np.union1d(at, at[at > 0] - 1) if len(at) * 8 < len(rank) else np.arange(len(rank))
            after = np.minimum(at + 1, len(symbols) - 1)
            same = (owner[after] == owner[at]) & (after > at)
            rank[at] = np.where(same, self.rank(symbols[at], symbols[after]), none)
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return symbols[order], np.bincount(owner, minlength=len(pieces))


def _slots(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)


def _quick_patterns(rule: str) -> tuple[re.Pattern, re.Pattern]:
    """What the quick path leaves to the library, and the file's rule with its classes spelled out up to _SETTLED.

    Left to it are all characters from there on, those below whose composed or lower-case form lies there, and special strings.
    """
    import regex

    def spelled(kind: str) -> str:
        return "".join(re.escape(chr(c)) for c in range(_SETTLED) if regex.match(kind, chr(c)))

    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        rule = rule.replace(kind, spelled(kind))
    forms = {c: unicodedata.normalize("NFC", chr(c)).lower() for c in range(_SETTLED)}
    leaving = "".join(re.escape(chr(c)) for c, form in forms.items() if max(map(ord, form)) >= _SETTLED)
    odd = re.compile(f"[^\\x00-{chr(_SETTLED - 1)}]|[{leaving}]|<\\|")
    return odd, re.compile(f"\\n|{rule}")


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = {b: chr(b) for b in shown}, 256
    for byte in range(256):
        if byte not in letters:
            letters[byte] = chr(spare)
            spare += 1
    return [letters[b] for b in range(256)]


class BatchTokenizer:
    """Token ids of texts, a batch at a time."""

    def __init__(self, raw: bytes) -> None:
        self.table = MergeTable(raw)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.known_bytes = 0
        # Of every remembered chunk: where its ids begin in the flat array, and how many there are.
        self.flat, self.begins, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids (32 bits each) of every text; null is empty."""
        for offsets, chunks in self._chunks(texts):
            sizes = self.sizes[chunks]
            ends = np.cumsum(sizes, dtype=np.int64)
            # A stretch has fewer than 2 ** 31 ids, as a text has fewer bytes.
            at = np.repeat((self.begins[chunks] - ends + sizes).astype(np.int32), sizes)
            at += np.arange(len(at), dtype=np.int32)
            ids = self.flat[at]
            stops = np.r_[0, ends][offsets].tolist()
            yield from (ids[a:b] for a, b in zip(stops, stops[1:]))

    def count(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of every text."""
        found = [np.zeros(0, np.int64)]
        for offsets, chunks in self._chunks(texts):
            found.append(np.diff(np.r_[0, np.cumsum(self.sizes[chunks], dtype=np.int64)][offsets]))
        return np.concatenate(found)

    def _chunks(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of a stretch of texts: where the chunks of each begin, and the numbers of all chunks. A long text is a stretch."""
        upto = np.r_[0, np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))]
        start = 0
        while start < len(texts):
            end = max(start + 1, int(np.searchsorted(upto, upto[start] + AT_ONCE, side="right")) - 1)
            cut = pc.ascii_split_whitespace(pc.fill_null(texts[start:end], ""))
            offsets = cut.offsets.to_numpy()
            coded = cut.flatten().dictionary_encode()
            numbers = self._numbers(coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist())
            yield offsets - offsets[0], numbers[coded.indices.to_numpy()]
            start = end

    def _numbers(self, chunks: list[bytes]) -> np.ndarray:
        """The numbers of different chunks, remembered or learnt now."""
        if len(self.known) > REMEMBERED or self.known_bytes > REMEMBERED_BYTES:
            self._forget()
        found = list(map(self.known.get, chunks))
        new = [c for c, n in zip(chunks, found) if n is None]
        if new:
            self._learn([c for c in new if c])
            if b"" in new:  # beside white space at either end
                self._remember([b""], np.zeros(0, np.uint32), np.zeros(1, np.int64))
            found = list(map(self.known.__getitem__, chunks))
        return np.array(found, np.int32)

    def _remember(self, chunks: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.known.update(zip(chunks, range(len(self.known), len(self.known) + len(chunks))))
        self.known_bytes += sum(map(len, chunks))
        self.begins = np.r_[self.begins, (len(self.flat) + np.cumsum(sizes) - sizes).astype(np.int32)]
        self.sizes, self.flat = np.r_[self.sizes, sizes.astype(np.int32)], np.r_[self.flat, ids]

    def _learn(self, chunks: list[bytes]) -> None:
        """Ids of chunks that were not known: the plain ones all at once, the odd ones each by the library's rules."""
        table, joined = self.table, b"\n".join(chunks).decode("utf-8", "replace")
        odd: list[bytes] = []
        if table.odd.search(joined):
            plain = []
            for chunk in chunks:
                (odd if table.odd.search(chunk.decode("utf-8", "replace")) else plain).append(chunk)
            chunks, joined = plain, b"\n".join(plain).decode()
        found: list = table.quick.findall(unicodedata.normalize("NFC", joined).lower() + "\n") if chunks else []
        specials: dict[str, bytes] = {}
        for chunk in odd:
            for part in table.special.split(chunk.decode("utf-8", "replace")):
                if part in table.specials:
                    specials[part] = table.specials[part]
                    found.append(part)
                elif part:
                    found += table.pieces(part)
            found.append("\n")
        number = dict.fromkeys(found)
        for other in ("\n", *specials):
            number.pop(other, None)
        ids, counts = table.merge([p if isinstance(p, bytes) else p.encode() for p in number])
        number = dict(zip(["\n", *specials, *number], range(1 + len(specials) + len(number))))
        ids = np.r_[np.frombuffer(b"".join(specials.values()), "<u4"), ids].astype("<u4")
        counts = np.r_[0, np.ones(len(specials), np.int64), counts]
        of = np.fromiter(map(number.__getitem__, found), np.int64, len(found))
        begins, sizes = (np.cumsum(counts) - counts)[of], counts[of]
        ends = np.cumsum(sizes)
        flat = ids[np.arange(sizes.sum()) + np.repeat(begins - ends + sizes, sizes)]
        self._remember(chunks + odd, flat, np.diff(np.r_[0, ends[of == 0]]))


def vocabulary_bytes(path: str) -> bytes:
    """A vocabulary file, read where the job is planned; at most 64 MB, for it travels to every executor."""
    raw = Path(path).read_bytes()
    if len(raw) > 64 << 20:
        raise ValueError("a vocabulary of more than 64 MB is not broadcast")
    return raw


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Bytes and tokens of every whole text, and whether it has more than ``limit`` tokens.

    One pass without a shuffle. Null and empty texts have 0 bytes and 0 tokens; repeated rows give repeated results;
    null ids stay; other columns are not read. Columns: the id, ``n_bytes``, ``n_tokens``, ``over_limit``.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(vocabulary_bytes(tokenizer_path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = BatchTokenizer(vocabulary.value)
        for batch in batches:
            sizes = tokenizer.count(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes), pa.array(sizes > limit)],
                [id_column, "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    size = F.octet_length(F.coalesce(F.col(text_column), F.lit(""))).cast("long").alias("n_bytes")
    return docs.select(id_column, size, text_column).mapInArrow(
        count, f"`{id_column}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
