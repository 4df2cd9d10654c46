"""SimHash near-duplicates through a Gray-order hierarchical index.

A fingerprint bit is set if it is set in over half the hashes of the text's word shingles. Fingerprints
within ``MAX_BITS`` bits are linked; a component of links is a group of near-duplicates.

The upper nodes of the index are masked bit patterns. Of four blocks of 16 bits, two fingerprints that
differ in two bits at most agree on two blocks, so each fingerprint goes under the six patterns that two
of its blocks make, and linked fingerprints meet under at least one. Patterns are dealt over the tasks.
Under a pattern the fingerprints stand in the order of their Gray rank, where neighbours differ in few
bits; runs of them form nodes that keep the bits all members share, runs of nodes form the next level.
Two nodes are compared by the bits shared within both but different between them: every pair of members
differs in at least those, so more than ``MAX_BITS`` of them prune all the pairs at once.

Copies are no matter here: only distinct fingerprints enter, each once under a pattern. What leaves a
pattern is a spanning forest of its links, never all pairs. A pattern with more than ``MAX_MEMBERS``
distinct fingerprints is not searched in one task: there each member is dealt out once more under itself
and itself with one free bit flipped. Two members within two bits share such a key, and a key has at most
33 members.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from shelfcast.llm.common import stage, text_batches
from shelfcast.llm.components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
BLOCKS = 4
FANOUT = 8
MAX_MEMBERS = 10_000
# Pairs of nodes, or shingles, handled at a time.
CHUNK = 1 << 18


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


# Masks of two blocks of 16 bits, as signed 64-bit integers.
BLOCK = [0xFFFF << (16 * i) for i in range(BLOCKS)]
MASKS = [_signed(a | b) for a, b in combinations(BLOCK, 2)]


def fingerprint(text: str | None) -> int:
    """The unsigned fingerprint of one whole text; 0 without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # of bytes: ASCII only, both times
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))
    n = max(1, len(words) - SHINGLE + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        bits = np.unpackbits(hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


@F.pandas_udf(LongType())
def _fingerprint(texts: pd.Series) -> pd.Series:
    return pd.Series([_signed(fingerprint(t)) for t in texts], dtype="int64")


def gray_rank(x: Column) -> Column:
    """The place of a 64-bit pattern in Gray order: each bit with all higher ones folded in."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, shift))
    return x


def _levels(prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The index over sorted fingerprints: by level, the AND and the OR of each node, leaves first."""
    levels = [(prints, prints)]
    while len(levels[-1][0]) > FANOUT:
        every, any_ = levels[-1]
        starts = np.arange(0, len(every), FANOUT)
        levels.append((np.bitwise_and.reduceat(every, starts), np.bitwise_or.reduceat(any_, starts)))
    return levels


def _near(level: tuple[np.ndarray, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether nodes i and j may hold linked members: few bits are set in all of one and none of the other."""
    every, any_ = level
    apart = (every[i] & ~any_[j]) | (every[j] & ~any_[i])
    return np.bitwise_count(apart) <= MAX_BITS


def linked_pairs(prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of positions i < j within ``MAX_BITS``, in chunks; ``prints`` are in Gray order."""
    levels = _levels(prints)
    top = len(levels) - 1
    i, j = np.triu_indices(len(levels[top][0]))
    todo = [(top, i, j)]
    while todo:
        depth, i, j = todo.pop()
        if len(i) > CHUNK:
            todo += [(depth, i[at : at + CHUNK], j[at : at + CHUNK]) for at in range(0, len(i), CHUNK)]
            continue
        ok = _near(levels[depth], i, j)
        i, j = i[ok], j[ok]
        if depth == 0:
            ok = i < j
            if ok.any():
                yield i[ok], j[ok]
            continue
        below = len(levels[depth - 1][0])
        step = np.arange(FANOUT)
        a = (i[:, None, None] * FANOUT + step[None, :, None]).repeat(FANOUT, axis=2).ravel()
        b = (j[:, None, None] * FANOUT + step[None, None, :]).repeat(FANOUT, axis=1).ravel()
        ok = (a < below) & (b < below) & (a <= b)
        todo.append((depth - 1, a[ok], b[ok]))


def forest(prints: np.ndarray) -> np.ndarray:
    """For each fingerprint of one pattern the position of the first one in its component of links."""
    label = np.arange(len(prints))
    for i, j in linked_pairs(prints):
        while True:
            a, b = label[i], label[j]
            if (a == b).all():
                break
            low = np.minimum(a, b)
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            while (label != label[label]).any():
                label = label[label]
    return label


def _search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of sorted rows (mask, pattern, print): a run of equal (mask, pattern) is one pattern."""
    held = None
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        last = (held["mask"] == held["mask"].iloc[-1]) & (held["pattern"] == held["pattern"].iloc[-1])
        yield _links(held[~last])
        held = held[last]
    if held is not None:
        yield _links(held)


def _links(rows: pd.DataFrame) -> pd.DataFrame:
    mask, pattern = rows["mask"].to_numpy(), rows["pattern"].to_numpy()
    prints = rows["print"].to_numpy()
    fresh = np.flatnonzero((mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])) + 1
    starts = np.concatenate([[0], fresh]) if len(rows) else np.zeros(0, dtype=np.int64)
    ends = np.concatenate([fresh, [len(rows)]]) if len(rows) else starts
    out = []
    for a, b in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
        own = prints[a:b]
        label = forest(own.view(np.uint64))
        moved = np.flatnonzero(label != np.arange(b - a))
        out.append((own[moved], own[label[moved]]))
    if not out:
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    return pd.DataFrame({"a": np.concatenate([x for x, _ in out]), "b": np.concatenate([x for _, x in out])})


def links(prints: DataFrame, max_members: int = MAX_MEMBERS) -> DataFrame:
    """Links (a, b) that connect what is connected, from distinct fingerprints (print)."""
    under = F.array(
        *(F.struct(F.lit(i).alias("mask"), F.col("print").bitwiseAND(F.lit(m)).alias("pattern")) for i, m in enumerate(MASKS))
    )
    members = prints.select("print", F.inline(under))
    sizes = members.groupBy("mask", "pattern").count()
    large = stage(sizes.where(F.col("count") > max_members).drop("count"), "simhash-large")
    searched = members.join(large, ["mask", "pattern"], "left_anti")
    ordered = (
        searched.withColumn("rank", gray_rank(F.col("print")))
        .repartition("mask", "pattern")
        .sortWithinPartitions("mask", "pattern", "rank")
        .select("mask", "pattern", "print")
    )
    found = ordered.mapInPandas(_search, "a long, b long")
    masks = F.array(*(F.lit(m) for m in MASKS))
    free = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i))
    flips = F.filter(free, lambda bit: bit.bitwiseAND(F.get(masks, F.col("mask"))) == 0)
    dealt = members.join(large, ["mask", "pattern"], "left_semi").select(
        "mask", "pattern", "print", F.explode(F.concat(F.array(F.lit(0).cast("long")), flips)).alias("bit")
    )
    key = F.col("print").bitwiseXOR(F.col("bit")).alias("key")
    stars = dealt.select("mask", "pattern", key, "print")
    centres = stars.groupBy("mask", "pattern", "key").agg(F.min("print").alias("b"))
    far = stars.join(centres, ["mask", "pattern", "key"]).select(F.col("print").alias("a"), "b").where("a <> b")
    return found.unionByName(far)


def _group(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> tuple[DataFrame, DataFrame]:
    """Stored rows (id, print; with ``carry`` also row and doc), and (print, component, component_id)."""
    text_batches(docs.sparkSession)
    more = [F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")] if carry else []
    marked = docs.select(F.col(f"`{id_col}`").alias(id_col), _fingerprint(F.col(f"`{text_col}`")).alias("print"), *more)
    marked = stage(marked, "simhash-docs")
    prints = stage(marked.groupBy("print").agg(F.min(id_col).alias("first")), "simhash-prints")
    found = stage(links(prints.select("print")), "simhash-links")
    member = components(found).withColumnRenamed("node", "print")
    linked = prints.join(member, "print", "left").withColumn("component", F.coalesce("component", "print"))
    least = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    return marked, stage(linked.join(least, "component").select("print", "component", "component_id"), "simhash-components")


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The component of every row: (id, print, component_id).

    ``component_id`` is the least id reachable over links, the row's own included; null where no row of
    the component has an id. Null and empty texts have fingerprint 0 and link like any other. Repeated
    rows are all returned. Every shingle of a text counts, however long it is. Only the two named columns are read. An empty table gives an empty result.
    """
    marked, found = _group(docs, id_col, text_col, carry=False)
    return marked.join(found, "print").select(id_col, "print", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint in hexadecimal, component_id) of every row; see ``group``."""
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return group(docs, id_col, text_col).select(id_col, digits.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, that with the least id, and of its repeats one; columns of ``docs``."""
    marked, found = _group(docs, id_col, text_col, carry=True)
    # Ids in order, nulls last.
    order = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"), F.col("row").alias("r"))
    rows = marked.select(id_col, "print", "row").join(found, "print")
    kept = rows.groupBy("component").agg(F.min(order).alias("o")).select(F.col("o.r").alias("row"))
    return marked.join(stage(kept, "simhash-kept"), "row", "left_semi").select("doc.*")
