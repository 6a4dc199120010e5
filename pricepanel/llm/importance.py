"""Quality by importance resampling over hashed n-grams.

Two bags of hashed words and word pairs are counted: one over target texts, which are
labelled good, and one over all texts. A document's log weight is the sum, over its
n-grams, of the log ratio of the two smoothed frequencies: how much more likely the target
model is to write it. A sample of k documents without replacement in proportion to the
weights is drawn by adding Gumbel noise to the log weights and taking the k largest sums.
The noise is a hash of seed and id, so that reruns agree.

The raw counts cover all documents. The target texts are all good labelled documents up to
``MAX_TARGET``, the first by a hash of their id; that bound keeps the list of their ids small
enough to broadcast. Counts leave a task as one row per bucket, whatever the task read. The
k largest sums are found by range partitions of (id, sum) rows; no task sees all.

Edge cases: a null or empty text has log weight 0. A document with contradicting labels is
no target. Without targets all log weights are 0 and the sample is uniform. Rows that agree
in id get the same noise and are sampled one by one. Other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.llm.common import running_total, written
from pricepanel.llm.hashing import WordHashes, chunks, joined, scramble

BUCKETS = 10_000
MAX_TARGET = 20_000
# Share of the documents that the sample takes.
SHARE = 0.85
SEED = 17


def ngram_buckets(
    texts: list[bytes | None], memory: WordHashes, buckets: int = BUCKETS
) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Buckets of all words and pairs, the text each belongs to, and words per text."""
    hashes, counts = memory.of_texts(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    inside = owner[1:] == owner[:-1]
    pairs = joined(hashes[:-1], hashes[1:])[inside]
    found = np.concatenate([scramble(hashes), pairs]) % np.uint64(buckets)
    return found.astype(np.int64), np.concatenate([owner, owner[1:][inside]]), counts


def targets(
    labels: DataFrame,
    doc_id: str = "doc_id",
    max_target: int = MAX_TARGET,
    seed: int = SEED,
) -> DataFrame:
    """Ids of at most ``max_target`` documents labelled as good and not toxic."""
    good = labels.groupBy(F.col(doc_id).alias("doc_id")).agg(
        F.min(F.expr("quality = 1 AND toxic = 0")).alias("good")
    )
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    return good.where("good AND doc_id IS NOT NULL").orderBy(order, "doc_id").limit(
        max_target
    ).select("doc_id")


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """N-grams per bucket in all texts and in those with ``target``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        memory = WordHashes()
        for batch in batches:
            flags = batch.column("target").to_numpy(zero_copy_only=False).astype(bool)
            for start, texts_ in chunks(batch.column("text")):
                found, owner, _ = ngram_buckets(texts_, memory, buckets)
                raw += np.bincount(found, minlength=buckets)
                target += np.bincount(found[flags[start:][owner]], minlength=buckets)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(buckets)), pa.array(raw), pa.array(target)],
            ["bucket", "raw", "target"],
        )

    counts = texts.mapInArrow(count, "bucket long, raw long, target long")
    return counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The log ratio of target to raw frequency of every bucket, add-one smoothed."""
    raw, target = np.ones(buckets), np.ones(buckets)
    for row in counts.collect():  # one row per bucket
        raw[row["bucket"]] += row["raw"]
        target[row["bucket"]] += row["target"]
    if target.sum() == buckets:
        return np.zeros(buckets)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def log_weights(texts: DataFrame, ratios: np.ndarray) -> DataFrame:
    """doc_id, n_words and log_weight of every row."""
    shared = texts.sparkSession.sparkContext.broadcast(ratios)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, memory = shared.value, WordHashes()
        for batch in batches:
            sums, counts = np.zeros(batch.num_rows), []
            for start, texts_ in chunks(batch.column("text")):
                found, owner, n = ngram_buckets(texts_, memory, len(table))
                sums[start : start + len(n)] = np.bincount(
                    owner, weights=table[found], minlength=len(n)
                )
                counts += n
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(sums)],
                ["doc_id", "n_words", "log_weight"],
            )

    return texts.mapInArrow(weigh, "doc_id long, n_words long, log_weight double")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Standard Gumbel noise out of a hash of the id."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id), 11) + 0.5) / float(1 << 53)
    return -F.ln(-F.ln(uniform))


def resample(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    share: float = SHARE,
    buckets: int = BUCKETS,
    max_target: int = MAX_TARGET,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: words, log weight, noisy log weight and whether it is sampled."""
    texts = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")
    )
    chosen = written(targets(labels, max_target=max_target, seed=seed), "targets")
    chosen = chosen.withColumn("target", F.lit(True))
    marked = texts.join(F.broadcast(chosen), "doc_id", "left").select(
        "text", F.coalesce("target", F.lit(False)).alias("target")
    )
    ratios = log_ratios(bucket_counts(marked, buckets), buckets)
    weighed = log_weights(texts, ratios).withColumn(
        "noisy_weight", F.col("log_weight") + gumbel(F.col("doc_id"), seed)
    )
    rows = written(weighed.withColumn("__order", -F.col("noisy_weight")), "weights")
    k = int(np.ceil(share * rows.count()))
    ranked = running_total(rows, ["__order", "doc_id"], "__rank")
    return ranked.select(
        "doc_id", "n_words", "log_weight", "noisy_weight", (F.col("__rank") < k).alias("kept")
    )
