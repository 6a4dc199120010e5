from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from pricepanel.llm import merkle, oracle
from pricepanel.tables import BROADCAST_CONF

from .conftest import by_name


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    fields = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def levels_over(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [digest("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
        levels.append(nodes)
    return levels


def path_of(levels, place):
    path = []
    for level in levels[:-1]:
        start = place // 16 * 16
        path.append(("".join(level[start:place]), "".join(level[place + 1 : start + 16])))
        place //= 16
    return path


def plain_audit(df):
    """The rows of ``merkle.audit`` by a plain program."""
    by_source = {}
    for row in df.collect():
        by_source.setdefault(row["source"], []).append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        by_source[name].sort(
            key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"]))
        )
        trees.append(levels_over([leaf_of(r, r["text"]) for r in by_source[name]]))
    top = levels_over([tree[-1][0] for tree in trees])
    root = top[-1][0]
    for k, name in enumerate(names):
        for i, row in enumerate(by_source[name]):
            path = path_of(trees[k], i) + path_of(top, k)
            text = row["text"]
            hit = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0
            if hit and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = leaf_of(row, text)
            for before, after in path:
                folded = digest(before + folded + after)
            proof = digest("".join(before + after for before, after in path))
            own = leaf_of(row, row["text"])
            yield row["doc_id"], own, trees[k][-1][0], root, proof, folded, folded == root


def corpus(n, sources=5):
    rows = [(k, f"Text {k} É" if k % 3 else f"text {k}", f"s{k * k % sources}") for k in range(n)]
    return [*rows, (n, None, None), (n + 1, "", "lone"), (None, "No id", "s1"), (None, "No id 2", "s1")]


@pytest.mark.parametrize("limit", [None, "-1"])
def test_proofs_match_a_plain_program_and_sql(spark, documents, as_sql, limit):
    df = documents(*corpus(600), extra=("tree", "rank", "digest", "path"))
    if limit:
        spark.conf.set(BROADCAST_CONF, limit)
    try:
        got = merkle.audit(df).cache()
        assert got.count() == 604
    finally:
        spark.conf.unset(BROADCAST_CONF)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_audit(df), key=repr)
    assert by_name(got) == as_sql(oracle.MERKLE, documents=df)
    assert {True, False} == {r["verified"] for r in got.collect()}


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_sizes_around_whole_runs(documents, n):
    df = documents(*((k, f"t{k}") for k in range(n)))
    assert sorted(map(tuple, merkle.audit(df).collect())) == sorted(plain_audit(df))


def test_more_sources_than_one_run(documents):
    df = documents(*((k, f"T{k}", f"s{k % 40:02}") for k in range(90)))
    assert sorted(map(tuple, merkle.audit(df).collect())) == sorted(plain_audit(df))


def test_equal_rows_are_leaves_of_their_own(documents):
    df = documents(*[(7, "Same", None)] * 40, (8, "x" * 300_000))
    got = sorted(map(tuple, merkle.audit(df).collect()))
    assert got == sorted(plain_audit(df)) and len(got) == 41


def test_empty_table(documents):
    df = documents((1, "x")).where("false")
    assert merkle.audit(df).count() == 0 and merkle.build(df).root is None


def test_records_lead_from_the_root_to_every_leaf(documents):
    """Stored records alone, looked up by digest, are enough to find all leaves."""
    df = documents(*corpus(500))
    manifest = merkle.build(df)
    children = {r["digest"]: r["children"] for r in manifest.records.collect()}
    assert all(digest("".join(c)) == d and len(c) <= 16 for d, c in children.items())

    def leaves_below(node):
        return [x for c in children[node] for x in leaves_below(c)] if node in children else [node]

    wanted = sorted(r["digest"] for r in manifest.leaves.collect())
    assert sorted(leaves_below(manifest.root)) == wanted


def test_a_few_requests_are_proven_alone(documents):
    manifest = merkle.build(documents(*corpus(500)))
    asked = manifest.leaves.where("doc_id IN (3, 400)")
    proven = merkle.prove(manifest, asked)
    folded = proven.select("doc_id", merkle.fold(F.col("digest"), F.col("path")).alias("root"))
    assert {tuple(r) for r in folded.collect()} == {(3, manifest.root), (400, manifest.root)}
    changed = proven.select(merkle.fold(F.sha2("digest", 256), F.col("path")).alias("root"))
    assert manifest.root not in {r["root"] for r in changed.collect()}
