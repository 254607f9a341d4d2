"""Quality rules with a verdict per host.

Every document is measured by built-in functions alone and fails by itself when it has too
few words or repeats itself too much. The failures of a host, the document's source, are
counted; its failure rate is shrunk to the rate of all hosts with a beta prior, and where the
shrunk rate is above a limit all documents of the host are refused. The strength of the prior
comes from moments: the squared distances of the hosts' rates from the common rate, weighted by
documents, less what drawing so many documents at one common rate would give. Where that leaves
nothing, or no host has two documents, the hosts tell nothing apart and all take the common rate.

A null or empty text has no words and fails. A null source is no host: its documents stand for
themselves. Repeated rows count each. Windows of three words are compared by 64-bit hash. No
column but the id, the text and the source is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.llm.common import let, settled, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_HOST_RATE = 0.5
# The prior counts as many documents at least and at most.
WEAKEST_PRIOR, STRONGEST_PRIOR = 1.0, 1e6


def repeat_words(w: Column) -> Column:
    """How many of the words stand in a three-word window found twice or more."""

    def covered(h: Column) -> Column:
        placed = F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i")))

        def twice(s: Column) -> Column:
            same = lambda e, other: F.coalesce(e["x"] == other["x"], F.lit(False))
            found = F.filter(s, lambda e, k: same(e, F.get(s, k - 1)) | same(e, F.get(s, k + 1)))
            return F.sort_array(F.transform(found, lambda e: e["i"]))

        def add(state: Column, i: Column) -> Column:
            new = F.least(i - state["last"], F.lit(3))
            return F.struct((state["total"] + new).alias("total"), i.alias("last"))

        start = F.struct(F.lit(0).alias("total"), F.lit(-3).alias("last"))
        positions = let(F.sort_array(placed), twice)
        return F.aggregate(positions, start, add, lambda state: state["total"])

    def counted(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))

    starts = F.sequence(F.lit(0), F.size(w) - 3)
    windows = F.transform(starts, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) < 3, 0).otherwise(let(windows, counted))


def measures(text: Column) -> list[Column]:
    text = F.coalesce(text, F.lit(""))
    of_words = let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeat_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    worded = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    dup_lines = let(worded, lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))
    symbols = F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))
    return [
        of_words.alias("of_words"),
        symbols.cast("long").alias("n_symbols"),
        dup_lines.cast("long").alias("n_dup_lines"),
    ]


def measure(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """``doc_id, source``, the measures and ``base_failed`` for every row."""
    measured = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), *measures(F.col(text_col))
    ).select("doc_id", "source", "of_words.*", "n_symbols", "n_dup_lines")
    too_much = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    return measured.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | too_much)


def prior(hosts: int, n: int, failed: int, squares: float, scatter: float) -> tuple[float, float]:
    """Mean and strength of the beta prior of the hosts' failure rates.

    ``squares`` sums n * n over the hosts, ``scatter`` failed * failed / n. If a share r of the
    variance of one document lies between hosts, the weighted squared distances are expected to be
    mean * (1 - mean) * (hosts - 1 + r * room), and the strength is 1 / r - 1.
    """
    mean = failed / n
    room = n - squares / n - (hosts - 1)
    beyond = scatter - failed * mean - mean * (1 - mean) * (hosts - 1)
    # Below this the difference is rounding.
    if room < 1e-9 * n or beyond < 1e-9 * n * mean * (1 - mean) or not 0 < failed < n:
        return mean, STRONGEST_PRIOR
    between = beyond / (mean * (1 - mean) * room)
    return mean, min(max(1 / between - 1, WEAKEST_PRIOR), STRONGEST_PRIOR)


def host_rates(measured: DataFrame) -> DataFrame:
    """``source, n, failed, rate`` with the shrunk rate of every host."""
    hosts = settled(
        measured.where(F.col("source").isNotNull())
        .groupBy("source")
        .agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    )
    n, failed = F.col("n").cast("double"), F.col("failed").cast("double")
    sums = hosts.agg(
        F.count("*").alias("hosts"),
        F.sum("n").alias("n"),
        F.sum("failed").alias("failed"),
        F.sum(n * n).alias("squares"),
        F.sum(failed * failed / n).alias("scatter"),
    ).first()
    mean, strength = prior(*sums) if sums.hosts else (0.0, STRONGEST_PRIOR)
    shrunk = (F.col("failed") + mean * strength) / (F.col("n") + strength)
    return hosts.withColumn("rate", shrunk)


def judge(docs: DataFrame, max_host_rate: float = MAX_HOST_RATE, **columns) -> DataFrame:
    """``doc_id, source``, the measures, ``base_failed`` and ``kept`` for every row."""
    measured = settled(measure(docs, **columns))
    refused = host_rates(measured).where(F.col("rate") > max_host_rate).select("source", F.lit(True).alias("_refused"))
    return (
        measured.join(refused, "source", "left")
        .withColumn("kept", ~F.col("base_failed") & F.col("_refused").isNull())
        .drop("_refused")
    )
