"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension of a document is quantised to a few bits: texts like source and language
by their place among all rows in sorted order, so that every cell of a dimension has
about as many rows, and sizes by their binary logarithm. The cells lie on a Hilbert
curve, on which neighbours are near in every dimension. Rows are sorted by their place on
the curve and cut into runs of equal length, so a shard covers a small range of each
dimension, and a reader with a filter on any of them can skip most shards.

All of it is built-in expressions. Only ids and metadata move; positions over all rows
come from range partitions whose lengths are added up, so no task sees all rows.

Edge cases: a null text has no bytes and checksum 0; null sources and languages have a cell
of their own before all others. Equal rows get neighbouring slots. With fewer rows than
shards some shards are empty. An empty table gives an empty result. Other columns of the
input are not touched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.llm.common import running_total, written
from pricepanel.tables import lookup_join, materialize

BITS = 4
SHARDS = 16
# Texts shorter than 2 ** _SMALLEST bytes share the first size cell.
_SMALLEST = 5


def hilbert_index(point: Sequence[int], bits: int) -> int:
    """Place of a cell on the Hilbert curve through a cube of ``2 ** bits`` cells a side.

    From the highest bit down, the cube that holds the point is turned so that the curve
    enters and leaves its halves at neighbouring corners; the turned coordinates, bit by
    bit, are the place in Gray code.
    """
    axes = list(point)
    for level in range(bits - 1, 0, -1):
        half, below = 1 << level, (1 << level) - 1
        for k, value in enumerate(axes):
            if value & half:
                axes[0] ^= below
            else:
                swap = (axes[0] ^ value) & below
                axes[0] ^= swap
                axes[k] ^= swap
    gray = 0
    for level in range(bits - 1, -1, -1):
        for value in axes:
            gray = gray << 1 | value >> level & 1
    index = gray
    while gray := gray >> 1:
        index ^= gray
    return index


def hilbert_table(dimensions: int, bits: int) -> list[int]:
    """The place on the curve of every cell, cells counted with the first dimension slowest."""
    side = 1 << bits
    points = (
        [cell // side**k % side for k in range(dimensions - 1, -1, -1)]
        for cell in range(side**dimensions)
    )
    return [hilbert_index(point, bits) for point in points]


def size_cell(size: Column, bits: int = BITS) -> Column:
    """The binary logarithm of a size as a cell; very small and very large ones share one."""
    return F.least(
        F.lit((1 << bits) - 1), F.greatest(F.lit(0), F.length(F.bin(size)) - _SMALLEST)
    )


def value_cells(rows: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """A cell per value of a column, in the order of the values, each with its share of rows."""
    counts = materialize(rows.groupBy(column).agg(F.count(F.lit(1)).alias("__n"))).df
    total = counts.agg(F.sum("__n")).first()[0] or 1
    placed = running_total(counts, [column], "__before", "__n")
    cell = F.expr(f"CAST(__before * {1 << bits} DIV {total} AS INT)")
    return placed.select(column, cell.alias(f"__cell_{column}"))


def metadata(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    also: Sequence[str] = (),
) -> DataFrame:
    """What a shard is chosen by: id, size and checksum of the text, source and language."""
    filled = F.coalesce(F.col(text), F.lit(""))
    return documents.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(filled) + 1).cast("long").alias("size"),
        F.crc32(filled.cast("binary")).alias("text_crc32"),
        F.col(source).alias("source"),
        F.col(lang).alias("lang"),
        *also,
    )


def on_curve(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """Add ``curve``, the place of each row's cell; ``rows`` as ``metadata`` gives them."""
    for column in ("source", "lang"):
        cells = materialize(value_cells(rows.select(column), column, bits))
        rows = lookup_join(rows, cells, [column])
    places = F.array(*map(F.lit, hilbert_table(3, bits)))
    cell = (F.col("__cell_source") * (1 << bits) + F.col("__cell_lang")) * (1 << bits)
    return rows.withColumn("curve", F.get(places, cell + size_cell(F.col("size"), bits))).drop(
        "__cell_source", "__cell_lang"
    )


def _assigned(rows: DataFrame, shards: int, bits: int) -> DataFrame:
    """Stored rows, as ``metadata`` gives them, with curve, shard and slot."""
    order = ("curve", "doc_id", "size", "text_crc32")
    placed = running_total(on_curve(rows, bits), order, "__position")
    total = max(rows.count(), 1)
    shard = F.expr(f"CAST(__position * {shards} DIV {total} AS INT)")
    start = F.expr(f"(shard * {total}L + {shards - 1}) DIV {shards}")
    return (
        placed.withColumn("shard", shard)
        .withColumn("slot", (F.col("__position") - start).cast("long"))
        .drop("__position")
    )


def assign_shards(documents: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """One row per document: its metadata, place on the curve, shard and slot in the shard.

    Shards are consecutive runs along the curve whose row counts differ by one at most
    (law ``rows``).
    """
    assigned = _assigned(written(metadata(documents), "shards"), shards, bits)
    return assigned.withColumn("law", F.lit("rows")).withColumn(
        "grown_shard", F.lit(None).cast("int")
    )


def write_shards(documents: DataFrame, path: str, shards: int = SHARDS, bits: int = BITS) -> None:
    """Write the documents as one folder per shard, the shards of ``assign_shards``.

    Only metadata is put in order along the curve. The documents are then dealt by ranges
    of shard and slot and sorted inside of them, so a shard has as many files as ranges,
    each a run along the curve with narrow column ranges, and no task writes a whole shard.
    """
    columns = [F.col(f"`{c}`") for c in documents.columns]
    # Numbered once and stored: the number of a row must not change between the two reads.
    stored = written(
        documents.select(
            F.struct(*columns).alias("__row"), F.monotonically_increasing_id().alias("__number")
        ),
        "shards",
    )
    rows = written(metadata(stored.select("__row.*", "__number"), also=["__number"]), "shards")
    places = _assigned(rows, shards, bits).select("__number", F.col("shard").alias("__shard"), "slot")
    dealt = stored.join(places, "__number").repartitionByRange("__shard", "slot")
    ordered = dealt.sortWithinPartitions("__shard", "slot").select("__row.*", "__shard")
    ordered.write.partitionBy("__shard").parquet(path)
