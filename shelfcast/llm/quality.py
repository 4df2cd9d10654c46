"""Quality rules with adaptive thresholds.

Each text is measured as a whole. A few fixed rules reject outright; what passes them feeds quantile
sketches per language and source, and the sketches give each group its own cutoffs: fences around the
quartiles, as in a box plot, plus a slack that keeps a very uniform group from rejecting its own. A group
with few rows takes the cutoffs of its language, a rare language those of the whole corpus; the sketches
of those are the merged sketches of the groups. The cutoffs are joined back and filter the rows.

The sketch is a histogram with bins of bounded relative width: a value keeps its six leading binary
digits, so a quantile is off by at most 1/32 of itself, the number of bins is bounded for any number of
rows, and merging adds counts. It is exact to repeat: no order of merging changes it.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shelfcast.llm.common import stage, text_batches

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper_words", "n_echo_words"]
# Metric: (value as an integer, slack of its fence, whether it has a lower fence too). A slack is the noise of good
# rows: in a source without any repeats, one row in some hundred still repeats up to that much.
METRICS: dict[str, tuple[str, int, bool]] = {
    "word_length": ("100 * word_chars div greatest(n_words, 1)", 450, True),
    "symbols": ("1000 * n_symbols div greatest(word_chars, 1)", 15, False),
    "dup_lines": ("1000 * n_dup_lines div greatest(n_lines, 1)", 250, False),
    "repeats": ("1000 * n_repeat_words div greatest(n_words, 1)", 150, False),
    "echoes": ("1000 * n_echo_words div greatest(n_words, 1)", 100, False),
    "upper": ("1000 * n_upper_words div greatest(n_words, 1)", 150, False),
}
FENCE = 3
# Longer texts find their repeated windows by sorted integers instead of sets of tuples.
LONG_TEXT = 20_000


def _pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A number for each pair, equal for equal pairs only."""
    return np.unique(left.astype(np.int64) << 32 | right, return_inverse=True)[1]


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of five found at least twice, counted once each."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    if len(words) <= LONG_TEXT:
        windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
        if len(set(windows)) == n:
            return 0
        counts = Counter(windows)
        hit = np.fromiter((counts[w] > 1 for w in windows), dtype=bool, count=n)
    else:
        ids: dict[bytes, int] = {}
        single = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=len(words))
        two = _pairs(single[:-1], single[1:])
        four = _pairs(two[:-2], two[2:])
        five = _pairs(four[:-1], single[4:])
        hit = np.bincount(five)[five] > 1
    covered = np.zeros(len(words) + 1, dtype=np.int32)
    at = np.flatnonzero(hit)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + WINDOW, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def measure_text(text: str | None) -> tuple[int, ...]:
    """The numbers in ``COUNTS`` for one whole text; a null text has none of anything."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()  # of bytes: splits at the six ASCII white-space characters only
    white = len(raw) - sum(map(len, words))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text or "") - white,
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(map(bytes.isupper, words)),
        sum(map(eq, words, words[1:])),  # words equal to the one before
    )


@F.pandas_udf(StructType([StructField(name, LongType()) for name in COUNTS]))
def _measure(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure_text(t) for t in texts], columns=COUNTS).astype("int64")


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct ``_m`` of counts, ``_m.base_failed`` among them."""
    text_batches(docs.sparkSession)
    failed = F.expr("_c.n_words < 10 OR 100 * _c.n_repeat_words > 20 * _c.n_words")
    return (
        docs.withColumn("_c", _measure(F.col(f"`{text_col}`")))
        .withColumn("_m", F.struct("_c.*", failed.alias("base_failed")))
        .drop("_c")
    )


def sketch_bin(value: Column) -> Column:
    """The lower end of the value's bin: all but the six leading binary digits set to zero."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(measured: DataFrame) -> DataFrame:
    """Histogram sketches (lang, source, metric, bin, rows) of the rows that pass the fixed rules."""
    values = F.array(
        *(F.struct(F.lit(name).alias("metric"), F.expr(f"{value}").cast("long").alias("value")) for name, (value, _, _) in METRICS.items())
    )
    rows = measured.where(~F.col("_m.base_failed")).select("lang", "source", "_m.*")
    return (
        rows.select("lang", "source", F.inline(values))
        .groupBy("lang", "source", "metric", sketch_bin(F.col("value")).alias("bin"))
        .agg(F.count("*").alias("rows"))
    )


def merge(sketch: DataFrame, *keys: str) -> DataFrame:
    return sketch.groupBy(*keys, "metric", "bin").agg(F.sum("rows").alias("rows"))


def fences(sketch: DataFrame, keys: list[str], min_rows: int) -> DataFrame:
    """One row of cutoffs ``f`` for each key whose sketch holds at least ``min_rows`` rows."""
    whole = Window.partitionBy(*keys, "metric")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketch.withColumns({"upto": F.sum("rows").over(upto), "n": F.sum("rows").over(whole)})
    quartiles = (
        ranked.where(F.col("n") >= min_rows)
        .groupBy(*keys, "metric")
        .agg(
            F.min(F.when(4 * F.col("upto") >= F.col("n"), F.col("bin"))).alias("q1"),
            F.min(F.when(4 * F.col("upto") >= 3 * F.col("n"), F.col("bin"))).alias("q3"),
        )
    )
    spread = FENCE * (F.col("q3") - F.col("q1"))
    cut = []
    for name, (_, slack, both) in METRICS.items():
        of = lambda c, name=name: F.max(F.when(F.col("metric") == name, c))
        cut.append(of(F.col("q3") + spread + slack).alias(f"{name}_high"))
        if both:
            cut.append(of(F.col("q1") - spread - slack).alias(f"{name}_low"))
    names = [c for name, (_, _, both) in METRICS.items() for c in [f"{name}_high"] + [f"{name}_low"] * both]
    return quartiles.groupBy(*keys).agg(*cut).select(*keys, F.struct(*names).alias("f"))


def verdicts(measured: DataFrame, min_rows: int = 40) -> DataFrame:
    """Add ``kept`` to a measured, stored frame with columns ``lang`` and ``source``.

    ``kept`` is false where a fixed rule rejects or a metric lies outside the fences of the row's
    (language, source); null languages and sources are groups like any other. A group with fewer than
    ``min_rows`` rows that pass the fixed rules takes its language's fences, then the corpus's; without
    any, the fixed rules decide alone.
    """
    by_group = stage(sketches(measured), "quality-sketch")
    by_lang = merge(by_group, "lang")
    overall = fences(merge(by_group), [], min_rows).first()
    groups = measured.groupBy("lang", "source").agg(F.lit(1).alias("one"))
    same = lambda a, b, *names: [F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}")) for n in names]
    own = fences(by_group, ["lang", "source"], min_rows)
    lang = fences(by_lang, ["lang"], min_rows)
    cut = (
        groups.alias("g")
        .join(own.alias("o"), same("g", "o", "lang", "source"), "left")
        .join(lang.alias("l"), same("g", "l", "lang"), "left")
        .select("g.lang", "g.source", F.coalesce("o.f", "l.f").alias("f"))
    )
    cut = stage(cut, "quality-cutoffs")
    last = F.lit(None) if overall is None else F.struct(*(F.lit(v).alias(n) for n, v in overall["f"].asDict().items()))
    joined = measured.alias("d").join(cut.alias("c"), same("d", "c", "lang", "source"), "left")
    joined = joined.select("d.*", F.coalesce(F.col("c.f"), last.cast(cut.schema["f"].dataType)).alias("_f"))
    inside = F.lit(True)
    for name, (value, _, both) in METRICS.items():
        found = F.expr(_of_struct(value))
        inside &= F.coalesce(found <= F.col(f"_f.{name}_high"), F.lit(True))
        if both:
            inside &= F.coalesce(found >= F.col(f"_f.{name}_low"), F.lit(True))
    return joined.withColumn("kept", ~F.col("_m.base_failed") & inside).drop("_f")


def _of_struct(value: str) -> str:
    for name in COUNTS:
        value = value.replace(f" {name}", f" _m.{name}").replace(f"({name}", f"(_m.{name}")
    return value


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and verdict of every row: (id, counts, base_failed, kept).

    ``docs`` needs columns ``lang`` and ``source``; others are not read, whatever their names. Null and
    empty texts count zero words and fail; long texts are measured whole. Repeated rows are judged each; an empty table gives an empty
    result.
    """
    wanted = docs.select(
        F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("_text"), F.col("lang"), F.col("source")
    )
    measured = stage(measure(wanted, "_text").drop("_text"), "quality-counts")
    return verdicts(measured).select(id_col, "_m.*", "kept")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``."""
    measured = stage(
        measure(docs.select(F.struct("*").alias("_doc"), F.col(f"`{text_col}`").alias("_text"), "lang", "source"), "_text").drop("_text"),
        "quality-docs",
    )
    return verdicts(measured).where("kept").select("_doc.*")
