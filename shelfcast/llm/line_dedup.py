"""Line dedup by a deletion-neighbourhood join.

A line is its sequence of words in lower case. Two lines are near if one word inserted, deleted or replaced
turns one into the other. Emit for each line the sequences that deleting one word leaves, and the line
itself: near lines, and only these, share one of them at the same place, or have one equal to the other
line. A sequence is keyed by its length and two sums of hashes of (word, position), so all the variants
of a line take one pass with running sums.

Emitting variants for every line would write as many rows as the corpus has words. A replaced, inserted
or deleted word lies in one half of the line, so near lines agree on the other half; only lines that
share a half with another one can have a neighbour, and only these emit variants. This loses none.

Copies of a line meet in an aggregate; what follows sees distinct lines. Lines that share a variant meet
in aggregates too: each learns the earliest line of its variant, never the list of others. The proposed
neighbour is verified word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import stage

MIN_WORDS = 8
# Words of 64 bits in the filter of candidate places: at most so many rows of two longs are broadcast.
FILTER_WORDS = 1 << 20
NONE = -1


WHITE = r"[\x20\x09-\x0D]+"


def line_words(line: Column) -> Column:
    """The words of a line in lower case."""
    return F.array_remove(F.split(F.lower(line), WHITE), "")


def _raw_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every line with a word: (at, line)."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.xxhash64(text).alias("th"),
        # The outer form: for the inner one Spark infers a filter that splits the text once more.
        F.posexplode_outer(F.split(text, "\n")).alias("no", "line"),
    )
    rows = rows.where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    return rows.select(_place(F.col("id"), F.col("th"), F.col("no")).alias("at"), "line")


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every line with a word: (at, key, n, halves); the only pass that looks at all the words."""
    words = _raw_lines(docs, id_col, text_col).select("at", line_words(F.col("line")).alias("words"))
    return words.select(
        "at",
        F.unhex(F.md5(F.array_join("words", " "))).alias("key"),
        F.size("words").alias("n"),
        F.when(F.size("words") >= MIN_WORDS, _halves()).alias("halves"),
    )


def _place(id_: Column, text_hash: Column, number: Column) -> Column:
    """Places in reading order: by id, nulls last, then by line."""
    return F.struct(
        id_.isNull().alias("lost"), id_.alias("id"), text_hash.alias("th"), number.cast("int").alias("no")
    )


def _halves() -> Column:
    """Keys of the halves that a line shares with any near line: by the length of the shorter of the two."""
    keys, n = [], F.size("words")
    for less in (0, 1):
        short = n - less
        half = F.floor(short / 2).cast("int")
        keys.append(F.xxhash64(F.lit("front"), short, F.slice("words", F.lit(1), half)))
        keys.append(F.xxhash64(F.lit("back"), short, F.slice("words", n - half + 1, half)))
    return F.array(*keys)


def _term(salt: int, position: Column) -> Column:
    """40 bits of a word at a position; sums of them stay far below 63 bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(salt), F.col("word"), position), 24)


def _variants(lines: DataFrame) -> DataFrame:
    """Rows (key, at, pos, len, s0, s1): the line itself at ``NONE`` and without each of its words."""
    words = lines.select("key", "at", "n", F.posexplode("words").alias("i", "word"))
    terms = words.select(
        "key",
        "at",
        "n",
        "i",
        *(_term(s, F.col("i")).alias(f"p{s}") for s in (0, 1)),  # where the word stands
        *(_term(s, F.col("i") - 1).alias(f"q{s}") for s in (0, 1)),  # where it stands after a deletion before it
    )
    whole = Window.partitionBy("key", "at")
    upto = whole.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    sums = terms.select(
        "key",
        "at",
        "n",
        "i",
        *((F.sum(f"p{s}").over(upto) - F.col(f"p{s}") + F.sum(f"q{s}").over(whole) - F.sum(f"q{s}").over(upto)).alias(f"d{s}") for s in (0, 1)),
        *(F.sum(f"p{s}").over(upto).alias(f"t{s}") for s in (0, 1)),
    )
    cut = F.struct(F.col("i").alias("pos"), (F.col("n") - 1).alias("len"), F.col("d0").alias("s0"), F.col("d1").alias("s1"))
    itself = F.struct(F.lit(NONE).alias("pos"), F.col("n").alias("len"), F.col("t0").alias("s0"), F.col("t1").alias("s1"))
    each = F.when(F.col("i") == F.col("n") - 1, F.array(cut, itself)).otherwise(F.array(cut))
    return sums.select("key", "at", F.inline(each))


def _without(words: Column, pos: Column) -> Column:
    cut = F.concat(F.slice(words, F.lit(1), F.greatest(pos, F.lit(0))), F.slice(words, pos + 2, F.size(words)))
    return F.when(pos == NONE, words).otherwise(cut)


def _passing(raw: DataFrame, wanted: DataFrame) -> DataFrame:
    """The raw lines that may be candidates: a bitmap over hashed places, of bounded size, lets all of these pass.

    Others pass as often as their bit is set by chance, so fewer lines are shuffled for the join that decides;
    with more candidates than bits the filter keeps less out, and the result is the same.
    """
    hashed = F.xxhash64("at")
    word, bit = F.pmod(hashed, F.lit(FILTER_WORDS)), F.shiftrightunsigned(hashed, 58).cast("int")
    one = F.expr("shiftleft(1L, bit)")
    bitmap = wanted.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or(one).alias("bits"))
    tried = raw.withColumn("word", word).join(F.broadcast(bitmap), "word")
    return tried.where(F.getbit("bits", bit) == 1).select(*raw.columns)


def _neighbours(distinct: DataFrame, raw: DataFrame) -> DataFrame:
    """(key, near): the earliest place of a line that is near the line with this key."""
    halves = distinct.where(F.col("n") >= MIN_WORDS).select("key", "at", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").count().where("count > 1").select("half")
    wanted = stage(halves.join(shared, "half").select("key", "at").distinct(), "line-candidates")
    texts = stage(
        _passing(raw, wanted)
        .join(wanted, "at")
        .select("key", "at", line_words(F.col("line")).alias("words"))
        .select("key", "at", F.size("words").alias("n"), "words")
        .dropDuplicates(["key"]),  # of repeated rows one
        "line-texts",
    )
    variants = stage(_variants(texts), "line-variants")
    same = ["len", "s0", "s1"]
    by_place = variants.groupBy(*same, "pos").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    deleted = F.col("pos") != NONE
    met = by_place.groupBy(*same).agg(
        F.min(F.when(deleted, F.struct("first", "pos"))).alias("of_cut"),
        F.min(F.when(~deleted, F.struct("first", "pos"))).alias("of_itself"),
        F.sum("rows").alias("rows"),
    )
    met = stage(met.where("rows > 1").drop("rows"), "line-met")
    members = stage(variants.join(met, same), "line-members")
    here = members.groupBy(*same, "pos").agg(F.min("at").alias("here"))
    # A cut line is near the earliest line cut at the same place, and near the line that the rest is.
    partner = F.when(
        deleted, F.least(F.struct(F.col("here").alias("first"), F.col("pos").alias("pos")), F.col("of_itself"))
    ).otherwise(F.col("of_cut"))
    proposed = members.join(here, [*same, "pos"]).select("key", "at", "pos", partner.alias("to")).where("to.first < at")
    own = texts.select("key", F.col("words").alias("a"))
    other = texts.select(F.col("at").alias("first"), F.col("words").alias("b"))
    return (
        proposed.select("key", "pos", "to.first", F.col("to.pos").alias("to_pos"))
        .distinct()
        .join(own, "key")
        .join(other, "first")
        .where(_without(F.col("a"), F.col("pos")) == _without(F.col("b"), F.col("to_pos")))
        .groupBy("key")
        .agg(F.min("first").alias("near"))
    )


def judge_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every line with a word: (at, n, earliest, kept).

    ``earliest`` is the earliest place of an equal or near line, the line's own place if there is none
    before it; ``kept`` says which. Places order by id (nulls last), then line number. Lines of fewer
    than ``MIN_WORDS`` words are compared for equality only. Null texts and lines without words have no
    row. Texts and lines are read whole, however long. Rows that repeat both id and text are one document and get equal results. Columns other than
    the two named are not read; an empty table gives an empty result.
    """
    lines = stage(_lines(docs, id_col, text_col), "lines")
    distinct = (
        lines.groupBy("key")
        .agg(F.min("at").alias("at"), F.any_value("n").alias("n"), F.any_value("halves").alias("halves"))
    )
    distinct = stage(distinct, "line-distinct")
    near = _neighbours(distinct, _raw_lines(docs, id_col, text_col))
    first = stage(
        distinct.select("key", "at").join(near, "key", "left").select("key", F.least("at", "near").alias("earliest")),
        "line-first",
    )
    judged = lines.select("key", "at", "n").join(first, "key")
    return judged.select("at", "n", "earliest", (F.col("at") == F.col("earliest")).alias("kept"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, line_no, n_words, kept, first id and line number of the earliest equal or near line)."""
    return judge_lines(docs, id_col, text_col).select(
        F.col("at.id").alias(id_col),
        F.col("at.no").alias("line_no"),
        F.col("n").alias("n_words"),
        "kept",
        F.col("earliest.id").alias(f"first_{id_col}"),
        F.col("earliest.no").alias("first_line_no"),
    )


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the lines that are not kept, same columns.

    A document that loses all its lines with words goes. One that loses none keeps its text as it is, and
    so does one without any word. A column ``n_chars`` follows the new text.
    """
    judged = judge_lines(docs, id_col, text_col)
    lost = judged.where(~F.col("kept")).select("at")
    dropped = stage(
        lost.groupBy("at.lost", "at.id", "at.th").agg(F.collect_set("at.no").alias("gone")).select("id", "th", "gone"),
        "line-dropped",
    )
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.struct("*").alias("doc"), F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    same = [F.col("r.id").eqNullSafe(F.col("g.id")), F.col("r.th") == F.col("g.th")]
    joined = rows.alias("r").join(dropped.alias("g"), same, "left").select("doc", "text", "gone")
    split = F.split("text", "\n")
    # A flag for each line by its number, so that the lines are walked once.
    numbers = F.sequence(F.lit(0), F.size(split) - 1)
    flags = F.array_sort(
        F.concat(
            F.transform("gone", lambda i: F.struct(i.alias("i"), F.lit(False).alias("stays"))),
            F.transform(F.array_except(numbers, F.col("gone")), lambda i: F.struct(i.alias("i"), F.lit(True).alias("stays"))),
        )
    )
    lines = F.zip_with(split, flags, lambda line, flag: F.when(flag["stays"], line))
    left = F.concat_ws("\n", lines)  # without the nulls
    out = joined.select("doc", F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("text"), "gone")
    out = out.where(F.col("gone").isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return out.select(
        *(
            (
                F.col("text")
                if name == text_col
                else F.when(F.col("gone").isNull(), F.col("doc.n_chars")).otherwise(F.length("text")).cast(docs.schema[name].dataType)
                if name == "n_chars"
                else F.col(f"doc.`{name}`")
            ).alias(name)
            for name in docs.columns
        )
    )
