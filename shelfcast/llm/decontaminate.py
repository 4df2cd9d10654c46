"""Benchmark decontamination by template canonicalisation.

Numbers, names and units of a text become typed placeholders, so that a benchmark question whose
parameters were changed keeps its template. Windows of template tokens are hashed and joined: those of
every document against the rarer half of each item's, then all windows of the documents that have one of these. A
window of slots alone has no template and goes by its values. Where a document shows at least ``SHARE`` of an
item's windows, the slots decide: along one alignment of the two texts each value in the item's slots must stand for
one value in the document. "3 of 3" may become "5 of 5", not "5 of 7". The windows over slots that break
this are set aside, and what is left must still hold ``SHARE`` of the windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import bounded, stage

WINDOW = 8
SHARE = 0.5
BROADCAST_ROWS = 500_000
# Words that are units when they follow a number.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons gram grams kilogram kilograms "
    "pound pounds ounce ounces ml l liter liters litre litres second seconds minute minutes hour hours day "
    "days week weeks month months year years percent dollar dollars cent cents euro euros degree degrees "
    "meter meters metre metres kilometer kilometers"
).split()
SIGNS = ["%", "$", "€", "£"]
# A number, a word, a currency or percent sign, or the end of a sentence. The possessive group is matched in a loop;
# a greedy one recurses, and a long run of digits and separators would use up the stack.
TOKEN = r"[0-9]+(?:[.,][0-9]+)*+|\p{L}[\p{L}\p{M}]*|[%$€£]|[.!?\n]"
ENDS = [".", "!", "?", "\n"]
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"


def _digit(token: Column) -> Column:
    return F.substring(token, 1, 1).between("0", "9")


def _typed(token: Column, before: Column) -> Column:
    """Struct (value, slot): the token in lower case, and its placeholder if it fills a slot."""
    small = F.lower(token)
    unit = token.isin(SIGNS) | (_digit(before) & small.isin(UNITS))
    # A capital, then small letters, inside a sentence.
    first = F.substring(token, 1, 1)
    name = ~before.isin(ENDS) & (F.lower(first) != first) & (F.upper(token) != token)
    slot = F.when(_digit(token), NUMBER).when(unit, UNIT).when(name, NAME)
    return F.struct(small.alias("value"), slot.alias("slot"))


def with_tokens(rows: DataFrame, text_col: str) -> DataFrame:
    """Add ``found``, the typed tokens of a text; each step is a column, so that it is worked out once."""
    raw = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(TOKEN), F.lit(0))
    before = F.concat(F.array(F.lit("\n")), F.slice("_raw", F.lit(1), F.greatest(F.size("_raw") - 1, F.lit(0))))
    typed = F.zip_with("_raw", F.slice(before, F.lit(1), F.size("_raw")), _typed)
    found = F.filter(typed, lambda t: ~t["value"].isin(ENDS))
    return rows.withColumn("_raw", raw).withColumn("found", found).drop("_raw")


MIX = "(x, y) -> (xxhash64(x, y) & -2L) | (x & y & 1L)"
TAKE = "(h, v) -> CASE WHEN h & 1L = 1L THEN v ELSE h END"


def _hashed(slot: str) -> str:
    """Hash of each token's placeholder or value; the lowest bit tells that it is a slot."""
    return f"transform(found, t -> (xxhash64(coalesce({slot}, t.value)) & -2L) | CAST({slot} IS NOT NULL AS BIGINT))"


def _doubled(of: str, by: int) -> Column:
    """Hashes of runs of 2 ``by`` tokens, each from two of ``by``."""
    left = f"greatest(size({of}) - {by}, 0)"
    return F.expr(f"zip_with(slice({of}, 1, {left}), slice({of}, {by + 1}, {left}), {MIX})")


def _with_hashes(rows: DataFrame) -> DataFrame:
    """Add what the windows are hashed from, array by array, so that a text costs in proportion to its length.

    ``_one`` to ``_eight`` hash the runs of 1, 2, 4 and 8 template tokens; the lowest bit tells whether all tokens of
    the run are slots. ``_v1`` to ``_v8`` do the same for the values, and are null where no run of 8 is slots alone.
    """
    values = "CASE WHEN exists(_eight, h -> h & 1L = 1L) THEN transform(found, t -> xxhash64(t.value)) END"
    rows = rows.withColumn("_one", F.expr(_hashed("t.slot")))
    for name, of, by in (("_two", "_one", 1), ("_four", "_two", 2), ("_eight", "_four", 4)):
        rows = rows.withColumn(name, _doubled(of, by))
    rows = rows.withColumn("_v1", F.expr(values))
    for name, of, by in (("_v2", "_v1", 1), ("_v4", "_v2", 2), ("_v8", "_v4", 4)):
        rows = rows.withColumn(name, _doubled(of, by))
    return rows


def _long_hashes() -> Column:
    """Hashes of all windows of ``WINDOW`` tokens; a window of slots alone goes by its values."""
    hashes = F.expr(f"CASE WHEN _v8 IS NULL THEN _eight ELSE zip_with(_eight, _v8, {TAKE}) END")
    return F.when(F.size("found") >= WINDOW, hashes)


def _with_short(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """Add ``_s<k>``, the hashes of all windows of k tokens, for lengths below ``WINDOW``.

    The first token of a window counts as at the start of a text, where a capital makes no name. A window of slots
    alone has no template and goes by its values.
    """
    if not lengths:
        return rows
    signs = ", ".join(f"'{sign}'" for sign in SIGNS)
    at_start = f"(CASE WHEN t.slot = '{NUMBER}' OR t.value IN ({signs}) THEN t.slot END)"
    rows = rows.withColumn("_head", F.expr(_hashed(at_start))).withColumn("_value", F.expr("transform(found, t -> xxhash64(t.value))"))
    for k in lengths:
        windows = f"greatest(size(found) - {k - 1}, 0)"
        shown, meant = f"slice(_head, 1, {windows})", f"slice(_value, 1, {windows})"
        for i in range(2, k + 1):
            shown = f"zip_with({shown}, slice(_one, {i}, {windows}), {MIX})"
            meant = f"zip_with({meant}, slice(_value, {i}, {windows}), {MIX})"
        rows = rows.withColumn(f"_s{k}", F.expr(shown))
        taken = f"CASE WHEN exists(_s{k}, h -> h & 1L = 1L) THEN zip_with(_s{k}, {meant}, {TAKE}) ELSE _s{k} END"
        rows = rows.withColumn(f"_s{k}", F.expr(taken))
    return rows


def item_windows(rows: DataFrame, short: list[int]) -> DataFrame:
    """Add ``windows``, hashes of all windows of ``length`` tokens; fewer tokens than a window, as in ``short``, are one."""
    hashed = _with_short(_with_hashes(rows), short)
    hashes = _long_hashes()
    for k in short:
        hashes = F.when(F.col("length") == k, F.col(f"_s{k}")).otherwise(hashes)
    return hashed.select(*rows.columns, hashes.alias("windows"))


def doc_windows(rows: DataFrame, short: list[int]) -> DataFrame:
    """Add ``windows``: arrays of hashes by window length, ``WINDOW`` and those in ``short``.

    A text of fewer tokens than ``WINDOW`` is one window.
    """
    size = F.size("found")
    hashed = _with_short(_with_hashes(rows), short)
    arrays = [(WINDOW, _long_hashes()), *((k, F.when((size >= WINDOW) | (size == k), F.col(f"_s{k}"))) for k in short)]
    spans = F.array(*(F.struct(F.lit(k).alias("length"), found.alias("hashes")) for k, found in arrays))
    return hashed.select(*rows.columns, spans.alias("windows"))


def _benchmark(benchmark: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[int]]:
    """(item, item_id, found, length, windows) of every item with a token, and the lengths below ``WINDOW``.

    Items may share an id, then any of them counts.
    """
    rows = benchmark.select(F.col(f"`{id_col}`").alias("item_id"), F.col(f"`{text_col}`").alias("text"))
    found = with_tokens(rows, "text").where(F.size("found") > 0).withColumn("th", F.xxhash64(F.col("found.value")))
    found = found.dropDuplicates(["item_id", "th"]).select("item_id", "found", F.least(F.size("found"), F.lit(WINDOW)).alias("length"))
    found = stage(found.withColumn("item", F.monotonically_increasing_id()), "leak-found")
    lengths = found.where(F.col("length") < WINDOW).select("length").distinct().collect()  # of seven at most
    short = sorted(row["length"] for row in lengths)
    return stage(item_windows(found, short), "leak-items"), short


def _known(probes: DataFrame) -> DataFrame:
    """(item, length, hash, first, times, windows, rare): the distinct windows of every item.

    A document that shows ``SHARE`` of an item's windows has at least one of any choice of them that leaves fewer than
    that share out. ``rare`` marks such a choice: the windows that the fewest items have.
    """
    own = probes.groupBy("item", "length", "hash").agg(F.min("item_pos").alias("first"), F.count("*").alias("times"))
    uses = own.groupBy("length", "hash").agg(F.count("*").alias("uses"))
    of_item = Window.partitionBy("item")
    needed = F.ceil(F.lit(SHARE) * F.col("windows"))
    return (
        own.join(uses, ["length", "hash"])
        .withColumn("windows", F.count("*").over(of_item))
        .withColumn("place", F.row_number().over(of_item.orderBy("uses", "hash")))
        .select("item", "length", "hash", "first", "times", "windows", (F.col("place") <= F.col("windows") - needed + 1).alias("rare"))
    )


PAIR = ["doc", "item"]


def _aligned(spots: DataFrame, probes: DataFrame) -> DataFrame:
    """(doc, item, pos, item_pos, hash, line): one place in the item for each place of a pair's document.

    A window that the item has once names its place. One that repeats in the item takes the line of the nearest such
    window before it, else after it, if the item has it there; else its first place. So a pair has no more rows
    than its document has windows, however often these repeat.
    """
    line = F.col("pos") - F.col("first")
    anchored = spots.withColumn("anchor", F.when(F.col("times") == 1, line))
    upto = lambda order: Window.partitionBy(*PAIR).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    near = anchored.withColumn("before", F.last("anchor", True).over(upto(F.col("pos")))).withColumn(
        "after", F.last("anchor", True).over(upto(F.desc("pos")))
    )
    tries = F.array(
        F.struct(F.lit(0).alias("choice"), F.col("before").alias("line")),
        F.struct(F.lit(1).alias("choice"), F.col("after").alias("line")),
        F.struct(F.lit(2).alias("choice"), line.alias("line")),
    )
    tried = near.select(*PAIR, "hash", "pos", F.inline(tries)).withColumn("item_pos", F.col("pos") - F.col("line"))
    there = tried.join(probes.select("item", "hash", "item_pos"), ["item", "hash", "item_pos"])
    best = there.groupBy(*PAIR, "pos", "hash").agg(F.min(F.struct("choice", "line", "item_pos")).alias("best"))
    return best.select(*PAIR, "pos", "hash", "best.line", "best.item_pos")


def _torn(slots: DataFrame, line: list[str]) -> DataFrame:
    """(line, at) of the slots that break with their item's value along a line.

    Where one value of the item stands for several, the most frequent of these is taken, of equally
    frequent ones the item's own; if neither decides, all of the value's slots are set aside.
    """
    counts = slots.groupBy(*line, "old", "new").agg(F.count("*").alias("n")).withColumn("own", F.col("old") == F.col("new"))
    top = F.max(F.struct("n", "own", "new")).alias("top")
    low = F.min(F.struct(-F.col("n"), ~F.col("own"), F.col("new").alias("new"))).alias("low")
    values = counts.groupBy(*line, "old").agg(top, low, F.count("*").alias("values")).where("values > 1")
    taken = values.select(*line, "old", F.when(F.col("top.new") == F.col("low.new"), F.col("top.new")).alias("taken"))
    return slots.join(taken, [*line, "old"]).where("taken IS NULL OR new <> taken").select(*line, "at")


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Pairs of a document and a benchmark item it shows: (id, _th, item_id, matched, windows, changed).

    ``matched`` of the item's ``windows`` distinct template windows occur in the document with consistent
    slots; ``changed`` counts its slot values that differ from the item's, at one place or at all, 0 for a
    plain copy. ``_th`` is
    a hash of the document's text. Null and empty texts on either side match nothing; an item shorter
    than a window counts as one window and is looked for anywhere in documents of ``WINDOW`` tokens or
    more; a document shorter than that counts as one window too, so such an item must fill it. Texts are read
    whole, however long; a window that a text repeats counts once. Repeated rows of a document give one row. Columns other than those named are not read. An empty table on
    either side gives an empty result.
    """
    items, short = _benchmark(benchmark, item_col, item_text)
    probes = stage(items.select("item", "length", F.posexplode("windows").alias("item_pos", "hash")), "leak-probes")
    known = stage(_known(probes), "leak-known")
    rare = stage(known.where("rare").select("length", "hash").distinct(), "leak-rare")

    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    # The outer form: for the inner one Spark infers a filter and copies the whole expression into it.
    spans = doc_windows(with_tokens(rows, "text"), short).select("id", "th", F.explode_outer("windows").alias("span"))
    hashed = spans.select("id", "th", "span.length", F.explode_outer("span.hashes").alias("hash"))
    hit = hashed.join(bounded(rare, BROADCAST_ROWS), ["length", "hash"], "left_semi")
    wanted = stage(hit.select("id", "th").distinct(), "leak-docs")

    # All windows of the few documents in question.
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ["id", "th"]]
    texts = rows.alias("a").join(bounded(wanted, BROADCAST_ROWS).alias("b"), same, "left_semi").dropDuplicates(["id", "th"])
    texts = doc_windows(with_tokens(texts, "text"), short).select("id", "th", "found", "windows")
    texts = stage(texts.withColumn("doc", F.monotonically_increasing_id()), "leak-texts")
    spans = texts.select("doc", F.explode("windows").alias("span"))
    seen = spans.select("doc", "span.length", F.explode(F.array_distinct("span.hashes")).alias("hash"))
    counts = seen.join(known, ["length", "hash"]).groupBy(*PAIR).agg(F.count("*").alias("matched"), F.max("windows").alias("windows"))
    pairs = stage(counts.where(F.col("matched") >= SHARE * F.col("windows")).select(*PAIR, "windows"), "leak-pairs")

    places = spans.select("doc", "span.length", F.posexplode("span.hashes").alias("pos", "hash"))
    shared = pairs.join(known.drop("windows"), "item")
    spots = places.join(shared.select(*PAIR, "length", "hash", "first", "times"), ["doc", "length", "hash"])
    close = stage(_aligned(spots, probes), "leak-close")
    line = [*PAIR, "line"]
    covered = close.select(*line, F.explode(F.sequence(F.col("item_pos"), F.col("item_pos") + WINDOW - 1)).alias("at")).distinct()
    of_item = items.select("item", F.posexplode("found").alias("at", "there")).where("there.slot IS NOT NULL")
    of_doc = texts.select("doc", F.posexplode("found").alias("doc_at", "here")).where("here.slot IS NOT NULL")
    slots = (
        covered.join(of_item, ["item", "at"])
        .withColumn("doc_at", F.col("line") + F.col("at"))
        .join(of_doc, ["doc", "doc_at"])
        .select(*line, "at", F.col("there.value").alias("old"), F.col("here.value").alias("new"))
    )
    slots = stage(slots, "leak-slots")
    torn = stage(_torn(slots, line), "leak-torn")
    spoiled = torn.select(*line, F.explode(F.sequence(F.col("at") - WINDOW + 1, F.col("at"))).alias("item_pos")).distinct()
    kept = stage(close.join(spoiled, [*line, "item_pos"], "left_anti"), "leak-kept")
    whole = slots.join(kept.select(*line).distinct(), line, "left_semi")
    changed = whole.where("old <> new").groupBy(*PAIR).agg(F.countDistinct("old").alias("changed"))
    left = kept.groupBy(*PAIR).agg(F.countDistinct("hash").alias("matched")).join(pairs, PAIR)
    return (
        left.where(F.col("matched") >= SHARE * F.col("windows"))
        .join(changed, PAIR, "left")
        .join(texts.select("doc", F.col("id").alias("_id"), "th"), "doc")
        .join(items.select("item", "item_id"), "item")
        .select(
            F.col("_id").alias(id_col), F.col("th").alias("_th"), "item_id", "matched", "windows",
            F.coalesce("changed", F.lit(0).cast("long")).alias("changed"),
        )
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that show a benchmark item, same columns."""
    found = stage(leaks(docs, benchmark, id_col, text_col).select(id_col, "_th").distinct(), "leaks")
    rows = docs.select(
        F.struct("*").alias("doc"), F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("th")
    )
    same = [F.col("a.id").eqNullSafe(F.col(f"b.{id_col}")), F.col("a.th") == F.col("b._th")]
    return rows.alias("a").join(bounded(found, BROADCAST_ROWS).alias("b"), same, "left_anti").select("doc.*")
