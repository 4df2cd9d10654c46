"""URL filters by a sort-merge range join.

A rule (host, path) covers its host and every subdomain, for paths that begin with the rule's. With
labels reversed and the path behind them, a host's rules are prefixes of canonical keys such as
``org.example/en/1``, and a prefix is an interval of keys. The rules of one host are nested or apart,
never crossing, so a sweep over the sorted keys keeps a stack of the active ones: a rule's start
pushes, its end pops, and the top is the longest rule over the key in hand.

The sweep is two windows over the sorted events. The running sum of +1 and -1 is the height of the
stack. The slot at height d holds the last rule whose start raised the stack to d: had it been popped
since, the stack would have had to pass through d again, and a later start would stand in the slot.

A url is looked up under each suffix of its host for which rules exist. Every suffix is a sweep of
its own; one that many urls share is dealt over several sweeps, each with a copy of that suffix's
rules (a handful of rows against thousands of urls).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import lower_ascii, stage

START, PROBE, END = 0, 1, 2


def rules_from(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A rule table from (host, path, verdict) literals."""
    rows = [F.struct(*(F.lit(v).alias(n) for v, n in zip(r, ("host", "path", "verdict")))) for r in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def split_url(url):
    """Host (A-Z lowered) and path of a url column; both empty for null or without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def judge(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    urls_per_sweep: int = 2000,
) -> DataFrame:
    """Verdict of every row of ``pages``: (id, host, path, rule, verdict).

    The longest fitting rule wins, counted in characters of host and path; at equal length the one with
    the longer host. A rule given twice with different verdicts blocks. Without a fitting rule the
    verdict is ``default`` and ``rule`` is null. Null and malformed urls have an empty host and path,
    fit no rule and get the default. Repeated rows and null ids come back as often as they came;
    columns other than the two named are not read, so their names cannot clash. An empty table gives
    an empty result, an empty rule table the default everywhere.
    """
    urls = pages.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{url_col}`").alias("__url"))
    host, path = split_url(F.col("__url"))
    urls = urls.select(id_col, host.alias("host"), path.alias("path"))

    # Rules: one row each, with the number of labels of the host.
    rules = (
        rules.select(
            lower_ascii(F.col("host")).alias("rule_host"),
            F.coalesce("path", F.lit("")).alias("rule_path"),
            F.col("verdict"),
        )
        .where("rule_host IS NOT NULL AND rule_host <> ''")
        .groupBy("rule_host", "rule_path")
        .agg(F.max("verdict").alias("rule_verdict"))
    )
    rules = stage(rules, "url-rules")
    depth = rules.select(F.max(F.size(F.split("rule_host", r"\."))).alias("n")).first()["n"] or 1

    # Each distinct url once, under every suffix of its host that has rules.
    labels = F.split("host", r"\.")
    levels = F.least(F.size(labels), F.lit(depth))
    suffixes = F.transform(
        F.sequence(F.lit(1), levels), lambda k: F.array_join(F.slice(labels, -k, k), ".")
    )
    distinct = urls.where("host <> ''").groupBy("host", "path").agg(F.lit(1).alias("one")).drop("one")
    probes = stage(distinct, "urls").select("host", "path", F.explode(suffixes).alias("suffix"))
    hosts = probes.groupBy("suffix").count()
    hosts = hosts.join(rules.select(F.col("rule_host").alias("suffix")).distinct(), "suffix").select(
        "suffix", F.ceil(F.col("count") / urls_per_sweep).cast("int").alias("sweeps")
    )
    hosts = stage(hosts, "url-hosts")
    reversed_suffix = F.array_join(F.reverse(F.split("suffix", r"\.")), ".")

    events = (
        rules.withColumnRenamed("rule_host", "suffix")
        .join(hosts, "suffix")
        .withColumn("prefix", F.concat(reversed_suffix, F.col("rule_path")).cast("binary"))
        .withColumn("sweep", F.explode(F.sequence(F.lit(0), F.col("sweeps") - 1)))
        # An end sorts behind every key with the prefix: no UTF-8 text holds the byte FF.
        .withColumn(
            "event",
            F.explode(
                F.array(
                    F.struct(F.col("prefix").alias("key"), F.lit(START).alias("kind"), F.lit(1).alias("step")),
                    F.struct(
                        F.concat("prefix", F.expr("X'FF'")).alias("key"),
                        F.lit(END).alias("kind"),
                        F.lit(-1).alias("step"),
                    ),
                )
            ),
        )
        .select(
            "suffix", "sweep", "event.*", F.lit(None).cast("string").alias("host"),
            F.lit(None).cast("string").alias("path"),
            F.struct("rule_path", "rule_verdict").alias("rule"),
        )
    )
    lookups = probes.join(hosts, "suffix").select(
        "suffix",
        F.pmod(F.xxhash64("host", "path"), F.col("sweeps")).cast("int").alias("sweep"),
        F.concat(reversed_suffix, F.col("path")).cast("binary").alias("key"),
        F.lit(PROBE).alias("kind"),
        F.lit(0).alias("step"),
        "host",
        "path",
        F.lit(None).cast(events.schema["rule"].dataType).alias("rule"),
    )
    line = Window.partitionBy("suffix", "sweep").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    slot = (
        Window.partitionBy("suffix", "sweep", "height")
        .orderBy("key", "kind")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    swept = (
        events.unionByName(lookups)
        .withColumn("height", F.sum("step").over(line))
        .withColumn(
            "top", F.last(F.when(F.col("kind") == START, F.col("rule")), ignorenulls=True).over(slot)
        )
        .where((F.col("kind") == PROBE) & (F.col("height") > 0))
    )
    longest = F.struct(
        (F.length("suffix") + F.length("top.rule_path")).alias("chars"),
        F.length("suffix").alias("host_chars"),
        F.concat("suffix", "top.rule_path").alias("rule"),
        F.col("top.rule_verdict").alias("verdict"),
    )
    decided = (
        swept.groupBy("host", "path").agg(F.max(longest).alias("best")).select("host", "path", "best.rule", "best.verdict")
    )
    return urls.join(decided, ["host", "path"], "left").select(
        id_col, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
