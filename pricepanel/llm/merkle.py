"""Merkle manifest of a dataset: records of digests and children, and proofs by descent.

Every row is a leaf, the digest of its fields. The leaves of a source, by id, form a tree of
runs of ``FANOUT`` nodes, each run the digest of its nodes; the last one of a source is its
subroot. The subroots, by source, form such a tree again, whose last digest is the root.
What is stored is content-addressed: a record per inner node, from its digest to the digests
of its children. Equal nodes share a record.

A proof is found by descent. A request knows the place of its leaf as digits to the base of
the fan-out: of the rank of its source, then of its rank within the source. From the root it
takes record after record, goes to the child that the next digit names and collects the
children beside it. Segments are collected from the root, a proof wants them from the leaf,
so they are reversed at the end.

Requests that still agree in all digits travel as one: a step handles every wanted node of a
height once, with the records of that height, and hands on at most ``FANOUT`` children. So no
digest is a hot key, neither the root's nor that of a source with most of the rows, and only the
last step, one row per run of leaves, is as long as the requests. Ranks come from ranges of
(source, id), of which no task sees more than a share, and runs are grouped by their number.

Edge cases: null fields count as ``-``. A null source is a source of its own, before all
others; null ids come before all others. Rows that agree in id and source follow each other by
digest; wholly equal rows are leaves of their own, beside each other. An empty table has
neither leaves nor a root, and proofs of none. A text of any length is hashed whole. Columns
beyond the five fields are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.llm.common import lower_ascii, running_total, written
from pricepanel.tables import Table, lookup_join, materialize

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 16
_BITS = 4
# Enough digits for any number of rows.
_MOST_DIGITS = 15


def field(value: Column) -> Column:
    """A field as it enters a leaf: its length in bytes and its value, or a mark for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(**changed: Column) -> Column:
    """The digest of a row's fields, some of them replaced."""
    return digest_of(F.concat(*(field(changed.get(f, F.col(f))) for f in FIELDS)))


def _depth(n: Column) -> Column:
    """Levels above ``n`` nodes until one remains."""
    steps = (F.when(n > FANOUT**k, 1).otherwise(0) for k in range(_MOST_DIGITS))
    return reduce(lambda a, b: a + b, steps)


@dataclass(frozen=True)
class Tree:
    """Records of one forest: trees named ``tree``, nodes numbered from 0 at every height."""

    records: DataFrame  # height, digest, children
    roots: DataFrame  # tree, depth, digest
    depth: int

    def records_of(self, height: int) -> DataFrame:
        return self.records.where(F.col("height") == height).select("digest", "children")


def _grow(leaves: DataFrame, kind: str) -> Tree:
    """Trees over ``tree``, ``rank``, ``n`` (the leaves of the tree) and ``digest``."""
    deepest = leaves.agg(F.max(_depth(F.col("n")))).first()[0] or 0
    level, depth = leaves, _depth(F.col("n"))
    records, roots = [], [leaves.where("n = 1").select("tree", F.lit(0).alias("depth"), "digest")]
    for height in range(1, deepest + 1):
        runs = (
            level.where(depth >= height)
            .groupBy("tree", "n", F.shiftright("rank", _BITS).alias("rank"))
            .agg(F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("nodes"))
            .withColumn("children", F.col("nodes.digest"))
            .withColumn("digest", digest_of(F.array_join("children", "")))
            .drop("nodes")
        )
        level = written(runs, f"{kind}-nodes")
        own = level.select(F.lit(height).alias("height"), "digest", "children")
        records.append(own.dropDuplicates(["digest"]))
        done = level.where(depth == height)
        roots.append(done.select("tree", F.lit(height).alias("depth"), "digest"))
    empty = leaves.limit(0).selectExpr("0 AS height", "digest", "array(digest) AS children")
    return Tree(
        reduce(DataFrame.unionByName, records, empty), reduce(DataFrame.unionByName, roots), deepest
    )


@dataclass(frozen=True)
class Manifest:
    """The stored tables of a dataset's tree."""

    leaves: DataFrame  # tree (rank of the source), rank, n, digest, and the columns kept
    sources: Table  # source, tree, n, subroot
    lower: Tree  # one tree per source
    upper: Tree  # over the subroots
    top: DataFrame  # leaves of the upper tree: tree (0), rank (that of the source), n, digest

    @property
    def records(self) -> DataFrame:
        """Digest to children, each digest once."""
        both = self.upper.records.unionByName(self.lower.records)
        return both.select("digest", "children").dropDuplicates(["digest"])

    @property
    def root(self) -> str | None:
        """The digest of the whole dataset, none of an empty one."""
        row = self.upper.roots.first()
        return row["digest"] if row else None


def build(documents: DataFrame, kept: dict[str, Column] | None = None) -> Manifest:
    """The manifest of a table with the five fields.

    ``kept`` are further columns of a leaf, computed from the row while its fields are read.
    """
    kept = kept or {}
    hashed = written(
        documents.select(
            F.col("source").cast("string").alias("source"),
            F.col("doc_id").cast("long").alias("doc_id"),
            leaf_digest().alias("digest"),
            *(column.alias(name) for name, column in kept.items()),
            # Parts equal rows, so that any number of them can be dealt over ranges.
            F.monotonically_increasing_id().alias("__tie"),
        ),
        "merkle-leaves",
    )
    order = ["source", "doc_id", "digest", "__tie"]
    placed = written(running_total(hashed, order, "__place"), "merkle-places")
    counted = materialize(
        placed.groupBy("source").agg(F.min("__place").alias("__first"), F.count("*").alias("n"))
    ).df
    sources = materialize(running_total(counted, ["source"], "tree"))
    leaves = written(
        lookup_join(placed, sources, ["source"])
        .withColumn("rank", F.col("__place") - F.col("__first"))
        .drop("__place", "__first", "__tie"),
        "merkle-ranks",
    )
    lower = _grow(leaves.select("tree", "rank", "n", "digest"), "merkle")
    subroots = lower.roots.withColumnRenamed("digest", "subroot")
    named = materialize(
        sources.df.select("source", "tree", "n").join(subroots.select("tree", "subroot"), "tree")
    )
    top = named.df.select(
        F.lit(0).cast("long").alias("tree"),
        F.col("tree").alias("rank"),
        F.lit(named.df.count()).cast("long").alias("n"),
        F.col("subroot").alias("digest"),
    )
    return Manifest(leaves, named, lower, _grow(top, "merkle-top"), top)


def _segment(children: Column, digit: Column) -> Column:
    """The children beside the one taken, those before it and those after it."""
    return F.struct(
        F.array_join(F.slice(children, F.lit(1), digit), "").alias("left"),
        F.array_join(F.slice(children, digit + 2, F.lit(FANOUT)), "").alias("right"),
    )


def _step(tree: Tree, nodes: DataFrame, wanted: DataFrame, height: int) -> DataFrame:
    """From the nodes of one height to those of the next that requests lead to.

    ``nodes`` have digest and ``path``, the segments so far; ``wanted`` has the digits to take.
    """
    fanned = (
        nodes.join(tree.records_of(height), "digest")
        .join(wanted, ["tree", "rank"])
        .select("tree", "rank", "path", "children", F.explode("digits").alias("digit"))
    )
    return fanned.select(
        "tree",
        (F.shiftleft("rank", _BITS) + F.col("digit")).alias("rank"),
        F.get("children", F.col("digit")).alias("digest"),
        F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))).alias("path"),
    )


def _descend(tree: Tree, starts: DataFrame, requests: DataFrame, kind: str) -> DataFrame:
    """Add ``path``, from the root downward, to requests with ``tree``, ``rank`` and ``n``.

    ``starts`` are the roots of the trees: their depth, digest and the path that led there. A
    leaf is asked for once.
    """
    depth = _depth(F.col("n"))
    run = F.shiftright("rank", _BITS).alias("rank")
    row = F.struct(*(F.col(f"`{c}`") for c in requests.columns))
    # The requests of a run stay together until the last step, so its path travels once.
    runs = written(
        requests.groupBy("tree", "n", run).agg(F.collect_list(row).alias("asked")), f"{kind}-runs"
    )
    wanted, below = {}, runs
    for height in range(2, tree.depth + 1):
        digit = F.col("rank").bitwiseAND(FANOUT - 1).cast("int")
        digits = (
            below.where(depth >= height)
            .groupBy("tree", "n", run)
            .agg(F.collect_set(digit).alias("digits"))
        )
        below = wanted[height] = written(digits, f"{kind}-wanted")

    def roots(height: int) -> DataFrame:
        own = starts.where(F.col("depth") == height)
        return own.select("tree", F.lit(0).cast("long").alias("rank"), "digest", "path")

    nodes = roots(max(1, tree.depth))
    for height in range(tree.depth, 1, -1):
        digits = wanted[height].select("tree", "rank", "digits")
        nodes = _step(tree, nodes, digits, height).unionByName(roots(height - 1))
        nodes = written(nodes, f"{kind}-paths")
    asked = nodes.join(tree.records_of(1), "digest").join(runs.where("n > 1"), ["tree", "rank"])
    asked = asked.select("path", "children", F.explode("asked").alias("__asked"))
    digit = F.col("__asked.rank").bitwiseAND(FANOUT - 1).cast("int")
    asked = asked.select(
        "__asked.*", F.concat("path", F.array(_segment(F.col("children"), digit))).alias("path")
    )
    lone = runs.where("n = 1").drop("n").join(roots(0), ["tree", "rank"])
    lone = lone.select("path", F.explode("asked").alias("__asked")).select("__asked.*", "path")
    return asked.unionByName(lone)


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """Add ``subroot`` and ``path`` to leaves of the manifest, each asked for once.

    ``path`` has the digests beside the way from the leaf's run up to the root: those before
    and those after it, each as one text.
    """
    empty = F.array().cast("array<struct<left:string,right:string>>")
    tops = manifest.upper.roots.select("tree", "depth", "digest", empty.alias("path"))
    asked = manifest.top.join(requests.select(F.col("tree").alias("rank")).distinct(), "rank")
    above = _descend(manifest.upper, tops, asked, "merkle-top")
    starts = materialize(
        above.select(F.col("rank").alias("tree"), "path").join(manifest.lower.roots, "tree")
    ).df
    found = _descend(manifest.lower, starts, requests, "merkle")
    subroots = manifest.sources.derive(manifest.sources.df.select("tree", "subroot"))
    return lookup_join(found, subroots, ["tree"]).withColumn("path", F.reverse("path"))


def siblings(path: Column) -> Column:
    """The digests of a path as one text."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the digests beside its way."""
    return F.aggregate(
        path, leaf, lambda own, s: digest_of(F.concat(s["left"], own, s["right"]))
    )


def tampered_digest() -> Column:
    """The leaf of a row tampered with, A-Z of its text in lower case; null for other rows."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return F.when(hit, leaf_digest(text=lower_ascii(F.col("text"))))


def audit(documents: DataFrame) -> DataFrame:
    """Prove every row of a table, and check the proofs against rows partly tampered with.

    A row without an id is not tampered with.
    """
    manifest = build(documents, {"tampered": tampered_digest()})
    proven = prove(manifest, manifest.leaves)
    found = F.coalesce("tampered", "digest")
    return proven.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(manifest.root).cast("string").alias("root"),
        digest_of(siblings(F.col("path"))).alias("proof_sha256"),
        fold(found, F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
