"""Benchmark decontamination with one Aho-Corasick automaton.

The benchmark is normalised to words (ASCII letters, digits and everything beyond ASCII,
A-Z in lower case), and every window of 13 consecutive words of an item is a pattern; an
item with fewer words is one pattern. The automaton reads word numbers, not characters,
so a pattern is 13 nodes long and cannot match inside a word. Each document is normalised
the same way and read once. The words that lie in a match are mapped back to character
positions in the original text.

The documents are not shuffled: the automaton is built in every Python worker from the
benchmark's texts, which are broadcast. A benchmark is a test set of known size; it is
measured first and refused beyond ``MAX_BENCHMARK_BYTES``. Its items are taken in blocks of
``BLOCK_WORDS`` words with one automaton each, which bounds the memory of a worker; a
benchmark of usual size is one block.

Edge cases: a null text, or one without words, has no words and no hits, on either side.
Equal items or windows count for every item that has them; an item without an id counts
under an empty name. Repeated documents are returned one by one. An empty benchmark hits
nothing. The other columns of the documents are kept as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.llm.common import unused_name

WINDOW = 13
BLOCK_WORDS = 1_000_000
MAX_BENCHMARK_BYTES = 256 * 1024 * 1024
# A document is contaminated if at least one in so many of its words is hit.
HIT_SHARE = 20

RESULT = (
    "n_words long, n_hit long, items array<string>, "
    "spans array<struct<start: int, end: int>>"
)
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
# Every byte outside of words becomes a space.
_TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def normalised(text: str | None) -> bytes:
    """The text with words in lower case and spaces elsewhere, byte by byte as long."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS)


class Scanner:
    """The automaton over the windows of some items."""

    def __init__(self, items: Iterable[tuple[str, str | None]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = normalised(text).split()
            known = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in words)
            for start in range(max(1, len(known) - window + 1) if known else 0):
                owners.setdefault(known[start : start + window], set()).add(item)
        self.automaton = None
        if owners:
            self.automaton = ahocorasick.Automaton(
                ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE
            )
            for pattern, having in owners.items():
                self.automaton.add_word(pattern, (len(pattern), frozenset(having)))
            self.automaton.make_automaton()

    def matches(self, words: Sequence[bytes]) -> Iterator[tuple[int, int, frozenset[str]]]:
        """First and last word, and items, of every occurrence of a window."""
        if self.automaton is None or not words:
            return
        number = self.numbers.get
        for last, (length, items) in self.automaton.iter(tuple([number(w, 0) for w in words])):
            yield last - length + 1, last, items


def _merged(ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of words, overlapping and adjacent ones joined."""
    joined: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if joined and first <= joined[-1][1] + 1:
            joined[-1] = (joined[-1][0], max(joined[-1][1], last))
        else:
            joined.append((first, last))
    return joined


def _character_spans(text: str, flat: bytes, ranges: list[tuple[int, int]]) -> list[dict]:
    """Word ranges as character positions in the original text."""
    raw = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in _WORD.finditer(flat)]
    spans, at_byte, at_char = [], 0, 0
    for first, last in ranges:
        start, end = places[first][0], places[last][1]
        at_char += len(raw[at_byte:start].decode("utf-8", "surrogatepass"))
        begin = at_char
        at_char += len(raw[start:end].decode("utf-8", "surrogatepass"))
        at_byte = end
        spans.append({"start": begin, "end": at_char})
    return spans


def scan_text(scanners: Iterable[Scanner], text: str | None) -> tuple:
    """Number of words, words hit, items found and spans hit of one text."""
    flat = normalised(text)
    words = flat.split()
    found: set[str] = set()
    ranges = set()
    for scanner in scanners:
        for first, last, items in scanner.matches(words):
            ranges.add((first, last))
            found |= items
    if not ranges:
        return len(words), 0, [], []
    merged = _merged(ranges)
    hit = sum(last - first + 1 for first, last in merged)
    return len(words), hit, sorted(found), _character_spans(text, flat, merged)


def _blocks(items: list[tuple[str, str | None]], block_words: int) -> list[list[tuple]]:
    blocks: list[list[tuple]] = [[]]
    room = block_words
    for item in items:
        n = len(normalised(item[1]).split())
        if n > room and blocks[-1]:
            blocks.append([])
            room = block_words
        blocks[-1].append(item)
        room -= n
    return blocks


def mark_hits(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    *,
    result: str = "hits",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Add the column ``result`` with the words, hits, items and hit spans of each document."""
    spark = documents.sparkSession
    asked = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")), F.col(item_text)
    ).toDF("item", "text")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > MAX_BENCHMARK_BYTES:
        raise ValueError(f"a benchmark of {size} bytes is to be scanned for in parts")
    items = sorted(((r["item"], r["text"]) for r in asked.collect()), key=repr)
    shared = spark.sparkContext.broadcast(_blocks(items, block_words))

    @F.pandas_udf(RESULT)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        blocks = shared.value
        only = Scanner(blocks[0], window) if len(blocks) == 1 else None
        for texts in batches:
            if only:
                rows = [scan_text([only], t) for t in texts]
            else:
                rows = _scan_in_blocks((Scanner(b, window) for b in blocks), list(texts))
            yield pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "spans"])

    return documents.withColumn(result, scan(F.col(text)))


def _scan_in_blocks(scanners: Iterable[Scanner], texts: list[str | None]) -> list[tuple]:
    """Like ``scan_text`` for each text, with one automaton in memory at a time."""
    flat = [normalised(t) for t in texts]
    found: list[set[str]] = [set() for _ in texts]
    ranges: list[set[tuple[int, int]]] = [set() for _ in texts]
    for scanner in scanners:
        for k, words in enumerate(flat):
            for first, last, items in scanner.matches(words.split()):
                ranges[k].add((first, last))
                found[k] |= items
    rows = []
    for k, words in enumerate(flat):
        merged = _merged(ranges[k])
        hit = sum(last - first + 1 for first, last in merged)
        spans = _character_spans(texts[k], words, merged) if merged else []
        rows.append((len(words.split()), hit, sorted(found[k]), spans))
    return rows


def contaminated(hits: Column, share: int = HIT_SHARE) -> Column:
    return (hits["n_hit"] > 0) & (share * hits["n_hit"] >= hits["n_words"])


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are not contaminated, as they are."""
    hits = unused_name(documents, "__hits")
    marked = mark_hits(documents, benchmark, text, result=hits)
    return marked.where(~contaminated(F.col(hits))).drop(hits)
