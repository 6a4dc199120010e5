"""Quality rules judged by host.

Every document is measured and tested by a few rules on its words, lines and
symbols. The failures are summed up by host. A host's failure rate is shrunk towards
the rate of all hosts by a beta prior whose strength is estimated from the hosts
themselves, and a host whose shrunk rate is too high loses all its documents.

All of it is built-in expressions. The text never moves: counts per host are combined
on the map side, and the verdicts are looked up where the documents lie.

Edge cases: a null text has no words and fails the base rules. Documents with a null
host share one host. Repeated rows are judged and returned one by one. Of an empty
table the result is empty. Columns of the input other than id, text and host are not
touched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.llm.common import let, unused_name, words_of, written
from pricepanel.tables import lookup_join, materialize

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """When a document fails a rule, and a host the judgement."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_symbol_percent: int = 10
    max_dup_line_percent: int = 30
    max_host_rate: float = 0.5


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


# Up to so many different repeated windows a text is scanned for each, which beats a sort.
_FEW = 64


def _repeat_words(words: Column) -> Column:
    """Words in a window of three words that occurs at least twice.

    Windows are compared by a 64-bit hash. Among the sorted hashes equal ones are
    neighbours, which gives the repeated windows, none in most texts. Where those
    begin, in order, is added up without overlap.
    """

    def covered(at: Column) -> Column:
        new = F.transform(
            at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))
        )
        return F.aggregate(new, F.lit(0), lambda a, b: a + b)

    def by_search(hashes: Column, twins: Column) -> Column:
        places = F.transform(hashes, lambda h, i: F.when(F.array_contains(twins, h), i))
        return F.array_compact(places)

    def by_sort(hashes: Column) -> Column:
        def has_twin(ordered: Column) -> Callable[[Column, Column], Column]:
            def test(window: Column, k: Column) -> Column:
                before = F.get(ordered, k - 1)["h"].eqNullSafe(window["h"])
                return before | F.get(ordered, k + 1)["h"].eqNullSafe(window["h"])

            return test

        windows = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return let(
            F.sort_array(windows),
            lambda x: F.sort_array(F.transform(F.filter(x, has_twin(x)), lambda w: w["i"])),
        )

    def count(hashes: Column, twins: Column) -> Column:
        few = let(by_search(hashes, twins), covered)
        many = let(by_sort(hashes), covered)
        return F.when(F.size(twins) == 0, 0).when(F.size(twins) <= _FEW, few).otherwise(many)

    def twins_of(hashes: Column) -> Column:
        return let(
            F.sort_array(hashes),
            lambda x: F.array_distinct(
                F.filter(x, lambda h, k: F.get(x, k - 1).eqNullSafe(h))
            ),
        )

    hashes = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda word, i: F.xxhash64(word, F.get(words, i + 1), F.get(words, i + 2)),
    )
    return let(hashes, lambda h: let(twins_of(h), lambda t: count(h, t)))


def measures(text: Column) -> Column:
    """The measures of one text as a struct."""
    filled = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(filled, "\n"), lambda line: line.rlike("[^ \\t\\n\\x0B\\f\\r]"))
    unmarked = F.regexp_replace(filled, "[" + SYMBOLS + "]", "")
    line_counts = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"),
        ),
    )
    word_counts = let(
        words_of(text),
        lambda x: F.struct(
            F.size(x).cast("long").alias("n"),
            F.length(F.array_join(x, "")).cast("long").alias("chars"),
            _repeat_words(x).cast("long").alias("repeat"),
        ),
    )
    return let(
        F.struct(word_counts.alias("w"), line_counts.alias("l")),
        lambda x: F.struct(
            x["w"]["n"].alias("n_words"),
            x["w"]["chars"].alias("word_chars"),
            (F.length(filled) - F.length(unmarked)).cast("long").alias("n_symbols"),
            x["l"]["dup"].alias("n_dup_lines"),
            x["w"]["repeat"].alias("n_repeat_words"),
            x["l"]["n"].alias("n_lines"),
        ),
    )


def base_failed(m: Column, limits: Limits = Limits()) -> Column:
    """Whether measures fail the base rules: few words, or mostly repeated ones."""
    repeated = 100 * m["n_repeat_words"] > limits.max_repeat_percent * m["n_words"]
    return (m["n_words"] < limits.min_words) | repeated


def any_failed(m: Column, limits: Limits = Limits()) -> Column:
    """Whether measures fail the base rules, or there are too many symbols or copied lines."""
    symbols = 100 * m["n_symbols"] > limits.max_symbol_percent * m["word_chars"]
    lines = 100 * m["n_dup_lines"] > limits.max_dup_line_percent * m["n_lines"]
    return base_failed(m, limits) | symbols | lines


def host_verdicts(judged: DataFrame, host: str, limits: Limits = Limits()) -> DataFrame:
    """One row per host: documents, failures, shrunk failure rate and verdict.

    ``judged`` has a boolean ``__failed``. The prior is a beta distribution with the
    mean of all documents; its strength follows from the spread of the host rates
    beyond what chance alone would give (method of moments). Hosts that differ no more
    than by chance give a strong prior, so that none is singled out.
    """
    counts = materialize(
        judged.groupBy(host).agg(
            F.count(F.lit(1)).alias("n_docs"), F.count_if("__failed").alias("n_failed")
        )
    ).df
    # Sums over the hosts; one row each.
    docs, failed, hosts = counts.agg(
        F.sum("n_docs"), F.sum("n_failed"), F.count(F.lit(1))
    ).first()
    if not docs:
        return counts.withColumns({"rate": F.lit(0.0), "rejected": F.lit(False)})
    mean = failed / docs
    own_rate = F.col("n_failed") / F.col("n_docs")
    off = counts.agg(F.sum(F.col("n_docs") * F.pow(own_rate - mean, 2))).first()[0]
    by_chance = mean * (1 - mean)
    between = off / docs - by_chance * hosts / docs
    strength = max(by_chance / max(between, 1e-9) - 1, 1.0)
    rate = (F.col("n_failed") + mean * strength) / (F.col("n_docs") + strength)
    return counts.withColumn("rate", rate).withColumn(
        "rejected", F.col("rate") > limits.max_host_rate
    )


def judge(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    limits: Limits = Limits(),
) -> DataFrame:
    """One row per document: its measures, ``base_failed``, its host's verdict and ``kept``.

    The documents are read once; what is kept of them for the second step is the
    measures only.
    """
    m = F.col("m")
    measured = documents.select(
        F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), measures(F.col(text)).alias("m")
    )
    rows = written(measured, "quality")
    rows = rows.select(
        "doc_id", "host", *(m[name].alias(name) for name in MEASURES),
        base_failed(m, limits).alias("base_failed"), any_failed(m, limits).alias("__failed"),
    )
    verdicts = materialize(host_verdicts(rows, "host", limits).select("host", "rejected"))
    judged = lookup_join(rows, verdicts, ["host"])
    return judged.select(
        "doc_id", *MEASURES, "base_failed", F.col("rejected").alias("host_rejected"),
        (~F.col("base_failed") & ~F.col("rejected")).alias("kept"),
    )


def keep_good(
    documents: DataFrame,
    text: str = "text",
    host: str = "source",
    limits: Limits = Limits(),
) -> DataFrame:
    """The documents that are kept, as they are.

    The documents are measured twice, once for the hosts and once to filter them, which
    spares a shuffle of the texts.
    """
    def failing(rule: Callable[[Column, Limits], Column]) -> Column:
        return let(measures(F.col(text)), lambda m: rule(m, limits))

    key = unused_name(documents, "__host")
    failures = documents.select(F.col(host).alias(key), failing(any_failed).alias("__failed"))
    verdicts = host_verdicts(failures, key, limits).where("rejected").select(key)
    kept = documents.where(~failing(base_failed)).withColumn(key, F.col(host))
    return lookup_join(kept, materialize(verdicts), [key], "left_anti").drop(key)
