"""Secret scans with an incremental ledger of blobs.

Every version of every file is addressed by the hash of its content. The ledger says which (blob, rule
version) pairs have been scanned and what each found; a scan touches only the texts of blobs with a pair
that it lacks, each once however many paths hold it, and applies only the rules that are new to the blob.
Findings join back to all paths by the hash.

Offsets come from the text between matches: splitting at a rule's pattern and extracting its matches see
the same leftmost, non-overlapping matches, so running sums of the lengths give every start.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import stage


@dataclass(frozen=True)
class Rule:
    """``keep`` is an optional pattern that a match must have; ``version`` changes with either."""

    kind: str
    pattern: str
    keep: str = ""
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


ASSIGNED = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
# The base kinds first, in the order of the contract. A run that the plain pattern matches
# from its first character needs no second test where the least length stands in the pattern.
BASE = (
    Rule("assign", ASSIGNED + r"[A-Za-z0-9+/_.=-]+", keep="^" + ASSIGNED + r"[A-Za-z0-9+/_.=-]{6,}$"),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
RULES = (
    *BASE,
    Rule("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
SPANS = "array<struct<start:int,end:int,rule:string>>"
LEDGER = f"blob string, pairs array<string>, spans {SPANS}"


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT CAST(NULL AS STRING) AS blob, CAST(NULL AS ARRAY<STRING>) AS pairs, CAST(NULL AS {SPANS}) AS spans").where("false")


def address(text):
    """The content address of a text; a null text has that of the empty one."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def scan_new(versions: DataFrame, ledger: DataFrame, rules=RULES) -> DataFrame:
    """The ledger rows that ``versions`` (text) add: (blob, pairs, spans).

    One row for each blob with a pair that the ledger lacks, holding those pairs and their findings. A finding
    names its rule and version, whatever the order of the rules.
    """
    keys = F.array(*(F.lit(r.key) for r in rules))
    seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("seen"))
    done = seen.where(F.size(F.array_except(keys, F.col("seen"))) == 0)
    texts = versions.select(address(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    blobs = (
        texts.join(done.select("blob"), "blob", "left_anti")
        .groupBy("blob")
        .agg(F.any_value("text").alias("text"))
        .join(seen, "blob", "left")
        .select("blob", "text", F.array_except(keys, F.coalesce("seen", F.array())).alias("pairs"))
    )
    found = None
    for rank, rule in enumerate(rules):
        pattern = F.lit(rule.pattern)
        matches = F.when(F.array_contains("pairs", rule.key), F.regexp_extract_all("text", pattern, F.lit(0)))
        one = F.struct(F.lit(rank).alias("rank"), matches.alias("matches"))
        found = [one] if found is None else [*found, one]
    rows = blobs.select(
        "blob",
        "pairs",
        "text",
        F.filter(F.array(*found), lambda x: F.size(x["matches"]) > 0).alias("found"),
    )
    # A blob without matches keeps one row with a null hit.
    hits = rows.select("blob", "pairs", F.when(F.size("found") > 0, F.col("text")).alias("text"), F.explode_outer("found").alias("hit"))
    gaps = F.lit(None).cast("array<string>")
    for rank, rule in enumerate(rules):
        gaps = F.when(F.col("hit.rank") == rank, F.split("text", rule.pattern, -1)).otherwise(gaps)
    keep = F.lit(False)
    for rank, rule in enumerate(rules):
        keep = F.when(F.col("hit.rank") == rank, F.col("match").rlike(rule.keep) if rule.keep else F.lit(True)).otherwise(keep)
    lengths = hits.select(
        "blob",
        "pairs",
        "hit",
        F.transform(gaps, lambda g: F.length(g)).alias("gaps"),
    ).select("blob", "pairs", "hit", "gaps", F.posexplode_outer("hit.matches").alias("i", "match"))
    order = Window.partitionBy("blob", "hit.rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = lengths.select(
        "blob",
        "pairs",
        "hit",
        keep.alias("keep"),
        F.length("match").alias("chars"),
        F.sum(F.get("gaps", F.col("i")) + F.length("match")).over(order).alias("end"),
    )
    span = F.struct(
        (F.col("end") - F.col("chars")).cast("int").alias("start"),
        F.col("end").cast("int").alias("end"),
        F.get(keys, F.col("hit.rank")).alias("rule"),
    )
    return placed.groupBy("blob").agg(
        F.any_value("pairs").alias("pairs"),
        F.sort_array(F.collect_list(F.when(F.col("keep"), span))).alias("spans"),
    )


def report(paths: DataFrame, ledger: DataFrame, rules=RULES) -> DataFrame:
    """``paths`` (any columns and ``blob``) with ``spans``, the findings of the given rule versions, by start, then rule.

    What other versions of a rule have found stays in the ledger and is not reported.
    """
    if len({r.kind for r in rules}) < len(rules):
        raise ValueError("two rules of one kind")
    keys, kinds = F.array(*(F.lit(r.key) for r in rules)), F.array(*(F.lit(r.kind) for r in rules))
    rank = (F.array_position(keys, F.col("s.rule")) - 1).cast("int")
    findings = (
        ledger.select("blob", F.explode("spans").alias("s"))
        .where(rank >= 0)
        .select("blob", F.struct(F.col("s.start").alias("start"), rank.alias("rank"), F.col("s.end").alias("end"), F.get(kinds, rank).alias("kind")).alias("s"))
        .groupBy("blob")
        .agg(F.sort_array(F.collect_set("s")).alias("spans"))
    )
    return paths.join(stage(findings, "secret-findings"), "blob", "left")


def scan(
    docs: DataFrame, ledger: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", rules=RULES
) -> tuple[DataFrame, DataFrame]:
    """Scan all versions: (id, blob, spans) of every row, and the rows to append to the ledger.

    Offsets are code points of the whole text, however long, ends exclusive. Null texts count as empty; a text without
    findings has null ``spans``. Repeated rows and texts are all reported. Columns other than the two
    named are not read. An empty table gives two empty frames.
    """
    spark = docs.sparkSession
    versions = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("text"))
    ledger = empty_ledger(spark) if ledger is None else ledger
    added = stage(scan_new(versions, ledger, rules), "secret-ledger")
    paths = versions.select(id_col, address(F.col("text")).alias("blob"))
    return report(paths, ledger.unionByName(added), rules), added


def _is(kind: str):
    return lambda s: s["kind"] == kind


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the hash of the base spans and all spans as a string, by start, then kind."""
    spans = F.coalesce("spans", F.array())
    joined = lambda of: F.concat_ws(
        ",", F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )
    base = [r.kind for r in BASE]
    return found.select(
        id_col,
        *(F.size(F.filter(spans, _is(k))).cast("long").alias(f"n_{k}") for k in base),
        F.sha2(joined(F.filter(spans, lambda s: s["kind"].isin(*base))), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )
