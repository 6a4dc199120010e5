from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricepanel.llm import importance
from pricepanel.llm.hashing import WordHashes

LABEL = "doc_id long, quality int, toxic int"


def corpus(n=300, seed=6):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        junk = k % 5 == 0
        vocabulary = [f"{'junk' if junk else 'fine'}{i}" for i in range(60)] + ["the", "of"]
        rows.append((k, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 80)))))
    return [*rows, (n, None), (n + 1, ""), (n + 2, " \t"), (n + 3, "THE of " * 9000)]


def buckets_of(text, buckets):
    """The buckets of words and pairs, text by text."""
    found, owner, counts = importance.ngram_buckets([(text or "").encode()], WordHashes(), buckets)
    n = len((text or "").split())
    assert counts == [n] and len(found) == n + max(0, n - 1) and not owner.any()
    return found.tolist()


def brute_weights(rows, targets, buckets):
    raw, good = Counter(), Counter()
    for k, text in rows:
        raw.update(buckets_of(text, buckets))
        if k in targets:
            good.update(buckets_of(text, buckets))
    n_raw, n_good = raw.total() + buckets, good.total() + buckets
    ratio = {b: math.log((good[b] + 1) / n_good) - math.log((raw[b] + 1) / n_raw) for b in range(buckets)}
    return {k: sum(ratio[b] for b in buckets_of(text, buckets)) for k, text in rows}


def test_weights_and_sample_match_brute_force(spark, documents):
    rows = corpus()
    labels = [(k, 0 if k % 5 == 0 else 1, 0) for k in range(0, 300, 2)]
    labels += [(1, 1, 1), (2, 0, 0), (None, 1, 0), (999, 1, 0), (4, 1, 0)]
    df = documents(*rows, extra=("target", "kept", "log_weight"))
    got = importance.resample(df, spark.createDataFrame(labels, LABEL), buckets=500, share=0.5)
    got = {r["doc_id"]: r for r in got.collect()}
    good = {k for k, q, t in labels if q and not t} - {1, 2}
    wanted = brute_weights(rows, good, 500)
    assert {k: r["log_weight"] for k, r in got.items()} == pytest.approx(wanted)
    kept = {k for k, r in got.items() if r["kept"]}
    assert len(kept) == math.ceil(len(rows) / 2)
    worst = min(got[k]["noisy_weight"] for k in kept)
    assert all(r["noisy_weight"] <= worst for k, r in got.items() if k not in kept)
    long = [k for k, t in rows if t and len(t.split()) > 20]
    fine = [k for k in long if k % 5]
    assert sum(k in kept for k in fine) > 3 * sum(k in kept for k in long if k % 5 == 0)


def test_the_noise_is_gumbel_and_agrees_between_runs(spark):
    noise = spark.range(20_000).select(importance.gumbel(F.col("id")).alias("g"))
    values = np.array([r["g"] for r in noise.collect()])
    assert values.mean() == pytest.approx(0.5772, abs=0.03)
    assert values.var() == pytest.approx(math.pi**2 / 6, abs=0.08)
    assert np.array_equal(values, [r["g"] for r in noise.collect()])


def test_targets_are_bounded_and_not_contradicted(spark):
    labels = [(k, 1, 0) for k in range(100)] + [(3, 0, 0), (4, 1, 1), (None, 1, 0)]
    df = spark.createDataFrame(labels, LABEL)
    ids = {r["doc_id"] for r in importance.targets(df).collect()}
    assert ids == set(range(100)) - {3, 4}
    few = {r["doc_id"] for r in importance.targets(df, max_target=10).collect()}
    assert len(few) == 10 and few < ids


def test_no_labels_and_empty_tables(spark, documents):
    nothing = spark.createDataFrame([], LABEL)
    df = documents((1, "a b"), (1, "a b"), (None, "c"), (2, None))
    got = importance.resample(df, nothing, share=1.0).collect()
    assert len(got) == 4 and all(r["log_weight"] == 0 and r["kept"] for r in got)
    assert importance.resample(df.where("false"), nothing).count() == 0
