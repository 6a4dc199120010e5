"""Exact deduplication by composable polynomial fingerprints and chunkwise comparison.

A text is a polynomial over the field of 2^61 - 1 elements, its bytes the coefficients, taken
at one base. Its fingerprint follows from those of its chunks: the one before is shifted by the
length of the one after, ``f(ab) = f(a) * base^len(b) + f(b)``, so chunks may be hashed apart
and combined in any order. A text of up to ``HUGE`` bytes is hashed where it lies, chunk by
chunk. A longer one is dealt out in chunks; each is hashed and shifted by what comes after it in
its own task, and the sum of all is the fingerprint, the same as if hashed in one place.

Texts that agree in fingerprint and length are candidates, and are then compared byte by
byte. Within a task every candidate is compared at once with the last seen text of its
fingerprint, kept in a bounded memory, and goes no further if equal: of a group of copies a
task hands on one text, however many it has read. What is handed on is cut into chunks. Those
of one place of one fingerprint are sorted together and streamed past, each compared with the
first; more than ``FAN_IN`` tasks are compared in lists first and the lists' first texts after
that, so no group comes together in one task. A text that differs from the first is told
apart by its digest, and what shares both is compared again, until nothing differs. Only these
comparisons read texts a second time, and no task holds more than some chunks.

Edge cases: a null text counts as empty, and empty texts are copies of each other. Of rows that
agree in text, that with the largest id stays, a null id being the smallest; of rows that agree
in both, one stays. An empty table gives an empty result. A text of any length is read whole.
Other columns are not touched.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.llm.common import written
from pricepanel.llm.hashing import chunks
from pricepanel.tables import Table, lookup_join, materialize, null_safe_join

CHUNK = 1 << 16
HUGE = 8 << 20
FAN_IN = 256
# Bytes of texts that a task remembers to compare others with.
REMEMBERED = 16 << 20
_KEY = ("fingerprint", "n_bytes", "label")


@dataclass(frozen=True)
class Polynomial:
    """Fingerprints in a prime field; the default is the field of 2^61 - 1 elements."""

    modulus: int = (1 << 61) - 1
    base: int = 0x1B873593CC9E2D51 % ((1 << 61) - 1)

    @cached_property
    def _powers(self) -> tuple[np.ndarray, np.ndarray]:
        """Falling powers of the base for the bytes of a chunk, in halves of 32 bits."""
        power, powers = 1, []
        for _ in range(CHUNK):
            powers.append(power)
            power = power * self.base % self.modulus
        falling = np.array(powers[::-1], np.uint64)
        return falling & np.uint64(0xFFFFFFFF), falling >> np.uint64(32)

    def of_chunk(self, data: bytes | memoryview) -> int:
        """The fingerprint of at most ``CHUNK`` bytes."""
        low, high = self._powers
        # A leading byte 0 must count, so that length is told by the value too.
        values = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
        start = CHUNK - len(values)
        # Sums of 2^16 products of 9 and 32 bits fit 64 bits.
        parts = int(values @ low[start:]), int(values @ high[start:])
        return (parts[0] + (parts[1] << 32)) % self.modulus

    def shifted(self, fingerprint: int, n_bytes: int) -> int:
        """What a fingerprint adds to that of a text in which so many bytes follow."""
        return fingerprint * pow(self.base, n_bytes, self.modulus) % self.modulus

    def joined(self, before: int, after: int, n_after: int) -> int:
        """The fingerprint of two texts in a row."""
        return (self.shifted(before, n_after) + after) % self.modulus

    def of(self, text: bytes) -> int:
        whole, view = 0, memoryview(text)
        for at in range(0, len(text), CHUNK):
            part = view[at : at + CHUNK]
            whole = self.joined(whole, self.of_chunk(part), len(part))
        return whole


FIELD = Polynomial()


def _bytes(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def fingerprints(
    documents: DataFrame, text: str, polynomial: Polynomial = FIELD, huge: int = HUGE
) -> DataFrame:
    """Add ``n_bytes`` and ``fingerprint``; of texts beyond ``huge`` bytes the latter is null."""

    @F.pandas_udf("long")
    def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([None if t is None else polynomial.of(t) for t in batch], dtype="Int64")

    n_bytes = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long")
    small = F.when(n_bytes <= huge, _bytes(F.col(text)))
    return documents.withColumns({"n_bytes": n_bytes, "fingerprint": of_texts(small)})


def dealt_fingerprints(
    documents: DataFrame, text: str, polynomial: Polynomial = FIELD, huge: int = HUGE
) -> DataFrame:
    """``digest`` and ``fingerprint`` of each different text beyond ``huge`` bytes.

    The chunks of a text are dealt over all tasks.
    """
    size = F.octet_length(text)
    long = documents.where(size > huge).select(
        F.sha2(_bytes(F.col(text)), 256).alias("digest"), _bytes(F.col(text)).alias("bytes"),
        size.cast("long").alias("n_bytes"),
    )
    starts = F.explode(F.sequence(F.lit(0), F.col("n_bytes") - 1, F.lit(CHUNK).cast("long")))
    pieces = long.select("digest", "n_bytes", "bytes", starts.alias("start")).select(
        "digest",
        "start",
        (F.col("n_bytes") - F.least(F.col("start") + CHUNK, "n_bytes")).alias("after"),
        F.substring("bytes", (F.col("start") + 1).cast("int"), F.lit(CHUNK)).alias("chunk"),
    )
    # Copies of a text meet here, chunk by chunk; each place of a text is hashed once.
    dealt = pieces.groupBy("digest", "start", "after").agg(F.first("chunk").alias("chunk"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [
                polynomial.shifted(polynomial.of_chunk(c.as_buffer()), a.as_py())
                for c, a in zip(batch["chunk"], batch["after"], strict=True)
            ]
            yield pa.record_batch([batch["digest"], pa.array(values, pa.int64())], ["digest", "part"])

    parts = dealt.mapInArrow(hashed, "digest string, part long")
    total = F.sum(F.col("part").cast("decimal(38,0)")) % F.lit(polynomial.modulus)
    return parts.groupBy("digest").agg(total.cast("long").alias("fingerprint"))


class _Remembered:
    """The last texts by key, as many as fit."""

    def __init__(self, most: int) -> None:
        self.most, self.size, self.texts = most, 0, OrderedDict()

    def has(self, key: tuple, text: bytes) -> bool:
        """Whether the text of this key is remembered; if there is none, it is from now on."""
        known = self.texts.get(key)
        if known is not None:
            self.texts.move_to_end(key)
            return known == text
        self.texts[key] = text
        self.size += len(text)
        while self.size > self.most and len(self.texts) > 1:
            self.size -= len(self.texts.popitem(last=False)[1])
        return False


_CHUNKS = "fingerprint long, n_bytes long, label string, digest string, start long, chunk binary"


def _one_a_task(candidates: DataFrame) -> DataFrame:
    """Chunks of the texts that a task has not seen before, ``task`` the number of the task."""

    def forwarded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Remembered(REMEMBERED)
        names = ["fingerprint", "n_bytes", "label", "digest", "start", "chunk"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

        def block(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
            )

        for batch in batches:
            keys = list(zip(*(batch[name].to_pylist() for name in (*_KEY, "digest")), strict=True))
            for first, texts in chunks(batch["bytes"]):
                rows, size = [], 0
                for key, text in zip(keys[first:], texts, strict=False):
                    if seen.has(key[:3], text):
                        continue
                    for at in range(0, max(1, len(text)), CHUNK):
                        rows.append((*key, at, text[at : at + CHUNK]))
                        size += len(rows[-1][-1])
                        if size > 1 << 22:
                            yield block(rows)
                            rows, size = [], 0
                if rows:
                    yield block(rows)

    return candidates.mapInArrow(forwarded, _CHUNKS).withColumn("task", F.spark_partition_id())


def _compared(pieces: DataFrame) -> DataFrame:
    """Rows whose chunk differs from the first of its list, and the first of each list.

    ``differs`` tells them apart. Rows of a list stream past in order, one chunk is kept.
    """
    place = [*_KEY, "start", "list"]

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, text = None, pa.py_buffer(b"")
        for batch in batches:
            kept, differs = [], []
            keys = zip(*(batch[name].to_pylist() for name in place), strict=True)
            for k, (key, chunk) in enumerate(zip(keys, batch["chunk"], strict=True)):
                own = chunk.as_buffer()
                if key != held:
                    held, text = key, pa.py_buffer(own.to_pybytes())
                    kept.append(k)
                    differs.append(False)
                elif not own.equals(text):
                    kept.append(k)
                    differs.append(True)
            names = [*_KEY, "digest", "start", "task", "chunk"]
            part = pa.Table.from_batches([batch.select(names)]).take(kept)
            yield from part.append_column("differs", pa.array(differs, pa.bool_())).to_batches()

    ordered = pieces.repartition(*place).sortWithinPartitions(*place, "digest")
    return ordered.mapInArrow(
        streamed,
        "fingerprint long, n_bytes long, label string, digest string, start long, task int, "
        "chunk binary, differs boolean",
    )


def differing(candidates: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """Key and digest of the texts that differ from the first one with their key.

    ``candidates`` have the key (fingerprint, length, label), ``digest`` and ``bytes``. Lists
    are by task at first; what comes first in them goes on to the next, shorter, lists.
    """
    pieces = written(_one_a_task(candidates), "dedup-chunks")
    most = pieces.agg(F.max("task")).first()[0] or 0
    found, width = [], fan_in
    while True:
        listed = pieces.withColumn("list", F.floor(F.col("task") / width))
        result = written(_compared(listed), "dedup-compared")
        found.append(result.where("differs").select(*_KEY, "digest"))
        if width > most:
            break
        pieces, width = result.where("NOT differs"), width * fan_in
    apart = found[0]
    for more in found[1:]:
        apart = apart.union(more)
    return apart.distinct()


def classes(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    polynomial: Polynomial = FIELD,
    huge: int = HUGE,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per document, with the key of its class: fingerprint, length and label.

    ``digest`` is that of the text, ``row`` a number of its own.
    """
    narrow = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    hashed = fingerprints(narrow, "text", polynomial, huge)
    digest = F.sha2(_bytes(F.col("text")), 256)
    rows = written(
        hashed.select(
            "doc_id", digest.alias("digest"), "n_bytes", "fingerprint", F.lit("").alias("label"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "dedup-rows",
    )
    dealt = None
    if not rows.where("fingerprint IS NULL").isEmpty():
        dealt = materialize(dealt_fingerprints(narrow, "text", polynomial, huge))
        rows = written(_completed(rows, dealt), "dedup-rows")

    apart = None
    while True:
        groups = rows.groupBy(*_KEY).agg(F.count("*").alias("n"))
        shared = groups.where("n > 1").select(*_KEY)
        if apart is not None:  # only what has been told apart needs another look
            told = apart.select(*_KEY).distinct()
            shared = null_safe_join(shared, told, _KEY, "left_semi")
        shared = materialize(shared)
        if shared.df.isEmpty():
            return rows
        texts = hashed.withColumn("label", F.lit(""))
        if dealt is not None or apart is not None:
            texts = texts.withColumn("digest", digest)
        if dealt is not None:
            texts = _completed(texts, dealt)
        if apart is not None:
            texts = _labelled(texts, apart)
        candidates = lookup_join(texts, shared, list(_KEY), "left_semi").select(
            *_KEY, digest.alias("digest"), _bytes(F.col("text")).alias("bytes")
        )
        differs = materialize(differing(candidates, fan_in)).df
        if differs.isEmpty():
            return rows
        if not differs.where("label <> ''").isEmpty():
            raise ValueError("two texts share fingerprint, length and digest")
        apart = differs.withColumn("label", F.col("digest"))
        rows = written(_labelled(rows, apart), "dedup-rows")


def _completed(rows: DataFrame, dealt: Table) -> DataFrame:
    """Rows with the fingerprints of texts that were dealt out in chunks."""
    long = rows.where("fingerprint IS NULL").drop("fingerprint")
    return rows.where("fingerprint IS NOT NULL").unionByName(lookup_join(long, dealt, ["digest"]))


def _labelled(rows: DataFrame, apart: DataFrame) -> DataFrame:
    """Rows with the label of their text, if it has one by now."""
    told = materialize(apart.select("fingerprint", "n_bytes", "digest", F.col("label").alias("__label")))
    joined = lookup_join(rows, told, ["fingerprint", "n_bytes", "digest"])
    return joined.withColumn("label", F.coalesce("__label", "label")).drop("__label")


def deduplicate(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    polynomial: Polynomial = FIELD,
    huge: int = HUGE,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per document: the row that stays for its text, and whether it is itself that."""
    rows = classes(documents, doc_id, text, polynomial, huge, fan_in)
    groups = rows.groupBy(*_KEY).agg(
        F.max("doc_id").alias("keep_id"),
        F.count("*").alias("group_size"),
        F.coalesce(F.max_by("row", "doc_id"), F.max("row")).alias("kept_row"),
    )
    # A text of its own needs no look-up.
    copied = materialize(groups.where("group_size > 1"))
    joined = lookup_join(rows, copied, list(_KEY))
    return joined.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id"))
        .otherwise(F.col("keep_id"))
        .alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("kept_row") == F.col("row"), F.lit(True)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
