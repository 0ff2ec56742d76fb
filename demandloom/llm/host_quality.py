"""Quality rules of documents, and of the hosts they come from.

Every document is tested by rules on its words, lines and symbols. Failures are added up by host; each
host's failure rate is shrunk towards the rate of all hosts with a beta prior fitted to the hosts
themselves, so a host with few documents isn't condemned for one bad page. Hosts whose rate is surely too
high, against half of their documents and against the rate of all hosts, lose all their documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from ._tables import let

SPACE = " \t\n\u000b\f\r"
SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
# A host is rejected as a whole if its shrunk rate, less so many standard deviations of its posterior, is
# above this rate and above so many times the rate of all documents.
MAX_HOST_RATE, TIMES_MEAN, DEVIATIONS = 0.5, 2.0, 2.0
# Bounds of the prior's weight, in documents.
LEAST_WEIGHT, MOST_WEIGHT = 2.0, 1000.0


def words_of(text: Column) -> Column:
    """Runs of characters that are not ASCII white space; none for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def _removed(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda s: F.translate(s, SPACE, "") != "")
    return let(lines, lambda s: F.size(s) - F.size(F.array_distinct(s)))


def repeated_window_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur at least twice, first occurrences included.

    Hashes only rule out texts without repeats; the windows themselves are compared in the others.
    """
    def exact(w: Column, h: Column) -> Column:
        windows = F.sort_array(F.transform(h, lambda x, i: F.struct(
            x.alias("h"), F.get(w, i).alias("a"), F.get(w, i + 1).alias("b"),
            F.get(w, i + 2).alias("c"), i.alias("at"))))

        def same(s: Column, i: Column, j: Column) -> Column:
            x, y = F.get(s, i), F.get(s, j)
            equal = ((x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]))
            return F.coalesce(equal, F.lit(False))

        def covered(s: Column) -> Column:
            marks = F.transform(s, lambda x, i: F.when(
                same(s, i, i - 1) | same(s, i, i + 1),
                F.array(x["at"], x["at"] + 1, x["at"] + 2)))
            return F.size(F.array_distinct(F.flatten(F.array_compact(marks))))

        return let(windows, covered)

    def of(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(
            F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        counted = let(hashes, lambda h: F.when(
            F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(exact(w, h)))
        return F.when(F.size(w) < 3, F.lit(0)).otherwise(counted)

    return let(words, of)


def measures(text: Column) -> Column:
    """All measures of a text as one struct, its words split once."""
    whole = F.coalesce(text, F.lit(""))
    return let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        (F.length(whole) - _removed(whole, SPACE)).cast("long").alias("word_chars"),
        _removed(whole, SYMBOLS).cast("long").alias("n_symbols"),
        repeated_lines(whole).cast("long").alias("n_dup_lines"),
        repeated_window_words(w).cast("long").alias("n_repeat_words")))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > 50 * n_words)


def host_verdicts(documents: DataFrame, host: str, failed: str, max_rate: float = MAX_HOST_RATE,
                  times_mean: float = TIMES_MEAN, deviations: float = DEVIATIONS) -> DataFrame:
    """Per host: documents, failures, the shrunk failure rate, its lower bound and whether it is rejected.

    The prior has the mean of all documents. Its weight is that of a beta-binomial whose rates differ
    between hosts as they do here (method of moments): what chance alone adds to the spread of observed
    rates, more for hosts with few documents, is taken off first. The weight has fixed bounds. A null host
    is a host of its own; an empty table has none. Five numbers reach the driver.
    """
    hosts = documents.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("documents"), F.sum(F.col(failed).cast("long")).alias("failures"))
    rate = F.col("failures") / F.col("documents")
    failures, total, first, second, chance = hosts.agg(
        F.sum("failures"), F.sum("documents"), F.avg(rate), F.avg(rate * rate), F.avg(1 / F.col("documents"))).first()
    mean, weight = 0.5, MOST_WEIGHT
    if total:
        mean = failures / total
        own = mean * (1 - mean)
        between = (second - 2 * mean * first + mean * mean) / own - chance if own else 0.0
        if between > 0:
            weight = min(max((1 - chance) / between - 1, LEAST_WEIGHT), MOST_WEIGHT)
    size = F.col("documents") + F.lit(weight)
    shrunk = (F.col("failures") + F.lit(mean * weight)) / size
    lowest = F.col("failure_rate") - deviations * F.sqrt(F.col("failure_rate") * (1 - F.col("failure_rate")) / (size + 1))
    return (hosts.withColumn("failure_rate", shrunk).withColumn("least_rate", lowest)
            .withColumn("host_rejected", F.col("least_rate") > max(max_rate, times_mean * mean)))


def apply_quality_rules(documents: DataFrame, text: str = "text", host: str = "source", carry=(),
                        max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Columns ``carry`` of every document, its measures, ``base_failed``, ``host_rejected``, ``kept``.

    A null or empty text has no words and fails. Repeated rows are judged and counted one by one; an
    empty table gives no rows. Measures are written to the shared folder once, and so are the rejected
    hosts: Spark joins them back by broadcast if they are few, and otherwise by a join that it can split
    where a host has a third of all rows.
    """
    measured = documents.select(
        F.struct(*[F.col(c) for c in carry]).alias("_row") if carry else F.lit(None).alias("_row"),
        F.col(host).alias("_host"), measures(F.col(text)).alias("_m"))
    measured = measured.select("_row", "_host", "_m.*").withColumn(
        "base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
    judged = stage(measured, "quality-measures")
    # Written first, so its size is known when the join is planned: few hosts need no shuffle of documents.
    bad = stage(host_verdicts(judged, "_host", "base_failed", max_rate).filter("host_rejected").select(
        F.col("host").alias("_bad_host"), F.lit(True).alias("_bad")), "rejected-hosts")
    rejected = F.coalesce("_bad", F.lit(False))
    made = (judged.join(bad, F.col("_host").eqNullSafe(F.col("_bad_host")), "left")
            .withColumn("host_rejected", rejected)
            .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected")))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
             "host_rejected", "kept"]
    return made.select(*[F.col("_row")[c].alias(c) for c in carry], *names)


def keep_good(documents: DataFrame, text: str = "text", host: str = "source",
              max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The documents that pass, with their own columns."""
    carried = documents.select(F.struct("*").alias("_doc"), F.col(text).alias("_text"), F.col(host).alias("_host"))
    judged = apply_quality_rules(carried, "_text", "_host", ("_doc",), max_rate)
    return judged.filter("kept").select("_doc.*")
