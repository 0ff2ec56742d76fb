"""URL filters by a sort-merge range join.

A rule covers a host with all its subdomains and the paths that start with its path. Reversed host labels
(``com.example.www.``) turn "this host and below" into "keys with this prefix", which is one interval of
the sorted keys. Intervals of prefixes nest, so one sweep over sorted keys with a stack of open intervals
finds all that cover a key. The sweep runs twice: over hosts, then over the paths below each rule host
that the first sweep found.

The stack is a row of window columns, one per nesting level: level ``d`` holds the interval of that level
that was opened last, and it is open as long as its key is a prefix of the current one. Sorted keys are
cut into range blocks; what is open at the start of a block is carried in from the blocks before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import stage
from ._tables import ascii_lower

# Lower than every character of a host or path, so keys of one host stay together.
CUT = "\u0001"


def url_host(url: Column) -> Column:
    """From behind ``://`` to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    return ascii_lower(F.regexp_extract(_behind_scheme(url), "^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """From behind the host to ``?``, ``#`` or the end."""
    return F.regexp_extract(_behind_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _behind_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_key(host: Column) -> Column:
    """Labels from the top level down, each followed by a dot; empty for an empty host."""
    labels = F.reverse(F.split(host, "\\."))
    return F.when(host == "", "").otherwise(F.concat(F.array_join(labels, "."), F.lit(".")))


def sweep(points: DataFrame, intervals: DataFrame, blocks: int | None = None) -> DataFrame:
    """All intervals that cover each point.

    ``points(key)`` are distinct sorted keys; ``intervals(key, level)`` each cover the keys that start
    with theirs, ``level`` counting from 1 how deep they nest. Returns ``key, stack``, outermost first.
    ``blocks`` fixes the number of range blocks; otherwise Spark chooses it from the size.
    """
    depth = intervals.agg(F.max("level")).first()[0] or 0
    if not depth:
        return points.select("key", F.array().cast("array<string>").alias("stack"))
    events = (points.select("key", F.lit(1).alias("kind"), F.lit(0).alias("level"))
              .unionByName(intervals.select("key", F.lit(0).alias("kind"),
                                            F.col("level").cast("int"))))
    order = ["key", "kind", "level"]
    ranged = (events.repartitionByRange(blocks, *order) if blocks
              else events.repartitionByRange(*order))
    blocked = stage(ranged.withColumn("block", F.spark_partition_id()), "url-sweep")

    def opened(d: int) -> Column:
        return F.when((F.col("kind") == 0) & (F.col("level") == d), F.col("key"))

    levels = range(1, depth + 1)
    # One row per block: the interval of each level that it opens last.
    last_of_block = blocked.groupBy("block").agg(*[F.max(opened(d)).alias(f"s{d}") for d in levels])
    before = W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carried = last_of_block.withColumns(
        {f"s{d}": F.last(f"s{d}", ignorenulls=True).over(before) for d in levels})
    carried = carried.select("block", F.explode(F.array(*[
        F.struct(F.col(f"s{d}").alias("key"), F.lit(d).alias("level")) for d in levels])).alias("open"))
    carried = carried.filter(F.col("open.key").isNotNull())
    running = W.partitionBy("block").orderBy("key", "kind").rowsBetween(W.unboundedPreceding, 0)
    swept = (blocked.unionByName(carried.select("open.key", F.lit(0).alias("kind"), "open.level", "block"))
             .withColumns({f"s{d}": F.last(opened(d), ignorenulls=True).over(running) for d in levels})
             .filter(F.col("kind") == 1))
    still_open = [F.when(F.startswith(F.col("key"), F.col(f"s{d}")), F.col(f"s{d}")) for d in levels]
    return swept.select("key", F.array_compact(F.array(*still_open)).alias("stack"))


def _nested(intervals: DataFrame, prefixes: Column) -> DataFrame:
    """Distinct keys with their nesting level: how many of the keys are prefixes of one, itself included."""
    keys = intervals.select("key").distinct()
    opened = keys.select(F.col("key").alias("inner"), F.explode(prefixes).alias("key"))
    return (opened.join(keys, "key").groupBy(F.col("inner").alias("key"))
            .agg(F.count("*").alias("level")))


def _host_prefixes() -> Column:
    labels = F.split(F.col("key"), "\\.")  # the key ends in a dot, so the last label is empty
    return F.transform(F.sequence(F.lit(1), F.size(labels) - 1),
                       lambda i: F.concat(F.array_join(F.slice(labels, 1, i), "."), F.lit(".")))


def _path_prefixes() -> Column:
    start = F.instr(F.col("key"), CUT)
    return F.transform(F.sequence(start, F.length("key")), lambda i: F.substring(F.col("key"), F.lit(1), i))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow",
          blocks: int | None = None) -> DataFrame:
    """Every row of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules(host, path, verdict)``: the longest rule (``host`` and ``path`` together) that fits decides,
    of equally long ones that with the longer host; of the same rule given twice the greater verdict
    (``block`` before ``allow``). Rules without a host fit nothing; a null path is empty.

    A null URL or one without ``://`` has an empty host and path and gets ``default``. Repeated rows are
    all kept; an empty table gives no rows. Columns of ``pages`` with the names of the four results are
    replaced.
    """
    clean = (rules.select(ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                          "verdict").filter(F.col("host") != "")
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
             .withColumn("host_key", host_key(F.col("host")))
             .withColumn("key", F.concat("host_key", F.lit(CUT), "path")))
    rule_hosts = _nested(clean.select(F.col("host_key").alias("key")), _host_prefixes())
    rule_paths = _nested(clean, _path_prefixes())

    named = pages.drop("host", "path", "rule", "verdict").withColumns(
        {"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    places = stage(named.select("host", "path").distinct(), "url-places")
    hosts = places.select("host").distinct().withColumn("key", host_key(F.col("host")))
    below = (sweep(hosts.select("key"), rule_hosts, blocks).filter(F.size("stack") > 0)
             .select(F.col("key").alias("host_key"), "stack"))
    probes = (places.withColumn("host_key", host_key(F.col("host"))).join(below, "host_key")
              .select("host", "path", F.explode("stack").alias("rule_host"))
              .withColumn("key", F.concat("rule_host", F.lit(CUT), "path")))
    probes = stage(probes.drop("rule_host"), "url-probes")
    hits = (sweep(probes.select("key").distinct(), rule_paths, blocks).filter(F.size("stack") > 0)
            .select("key", F.try_element_at("stack", F.lit(-1)).alias("rule_key")))
    wanted = clean.select(F.col("key").alias("rule_key"), F.struct(
        (F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
        F.concat("host", "path").alias("rule"), "verdict").alias("fit"))
    best = (probes.join(hits, "key").join(wanted, "rule_key")
            .groupBy("host", "path").agg(F.max("fit").alias("fit")))
    return (named.join(best, ["host", "path"], "left")
            .withColumns({"rule": F.col("fit.rule"), "verdict": F.coalesce("fit.verdict", F.lit(default))})
            .drop("fit"))
