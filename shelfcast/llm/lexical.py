"""Ranked lexical search with a hybrid of term-at-a-time and document-at-a-time.

The postings of the terms that occur in queries carry each term's share of a document's score. They are dealt by
document into slices of bounded size, and every query meets every slice. In a slice a query's short posting lists
are summed first, term at a time, into accumulators. These then act as one more list, sorted by document and bounded
by their largest sum, beside the long lists, which are bounded by their largest entry. Document at a time, over windows of
documents, the lists whose bounds together stay below the k-th best score so far propose no documents; they are only
looked up, by binary search, for proposed documents that can still reach that score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import bounded, stage, text_batches

SLICE = 1_000_000
GROUP_TERMS = 1_000_000
BROADCAST_ROWS = 500_000
# Lists are short while all of them together hold at most this share of a query's postings.
SHORT_SHARE = 0.25
WINDOW = 1024
# Bytes of a term: digits, letters and all of a non-ASCII character; A-Z lose their case, the rest separates.
KEPT = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def count_terms(text: bytes | None) -> tuple[int, dict[bytes, int]]:
    """Number of terms of a text, and how often each occurs."""
    found = (text or b"").translate(KEPT).split()
    return len(found), Counter(found)


def with_terms(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, n, terms, tfs) of every row; ``row`` tells rows apart."""
    text_batches(rows.sparkSession)
    wanted = rows.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ends, terms, tfs = [], [0], [], []
            for text in batch.column(2):
                size, counts = count_terms(text.as_py())
                n.append(size)
                terms.extend(counts.keys())
                tfs.extend(counts.values())
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(terms, pa.binary())),
                    pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64())),
                ],
                names=["row", "id", "n", "terms", "tfs"],
            )

    kind = wanted.schema["id"].dataType.simpleString()
    return wanted.mapInArrow(run, f"row long, id {kind}, n long, terms array<binary>, tfs array<long>")


def _sum(docs: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct documents in order, and the sums of their parts."""
    order = np.argsort(docs, kind="stable")
    docs, parts = docs[order], parts[order]
    starts = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]]) if len(docs) else np.empty(0, np.int64)
    return docs[starts], np.add.reduceat(parts, starts) if len(docs) else parts


def _top(docs: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to the lower document."""
    if len(docs) > 4 * k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        docs, scores = docs[scores >= kth], scores[scores >= kth]
    order = np.lexsort((docs, -scores))[:k]
    return docs[order], scores[order]


def hybrid(lists: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the k highest sums above 0 over posting lists (documents in order, parts above 0)."""
    lists = sorted((x for x in lists if len(x[0])), key=lambda x: len(x[0]))
    if not lists:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    upto = np.cumsum([len(x[0]) for x in lists])
    short = int(np.searchsorted(upto, SHORT_SHARE * upto[-1], side="right"))
    # Term at a time: the short lists become accumulators, one list with a bound of its own.
    if short:
        sums = _sum(np.concatenate([x[0] for x in lists[:short]]), np.concatenate([x[1] for x in lists[:short]]))
        lists = [sums, *lists[short:]]
    least = np.partition(lists[0][1], len(lists[0][1]) - k)[len(lists[0][1]) - k] if short and len(lists[0][1]) >= k else 1
    bounds = np.array([x[1].max() for x in lists])
    lists = [lists[i] for i in np.argsort(bounds, kind="stable")]
    bounds = np.sort(bounds, kind="stable")
    below = np.cumsum(bounds)  # what a document can get from this list and those with lower bounds
    end = max(int(x[0][-1]) for x in lists) + 1
    best = (np.empty(0, np.int64), np.empty(0, np.int64))
    low, width = min(int(x[0][0]) for x in lists), WINDOW
    # Document at a time, a window of documents in a step.
    while low < end:
        high = low + width
        first = int(np.searchsorted(below, least))  # lists before it propose nothing: together they stay below
        if first == len(lists):
            break
        cuts = [slice(*np.searchsorted(docs, (low, high))) for docs, _ in lists[first:]]
        docs, scores = _sum(
            np.concatenate([x[0][c] for x, c in zip(lists[first:], cuts)]), np.concatenate([x[1][c] for x, c in zip(lists[first:], cuts)])
        )
        for i in range(first - 1, -1, -1):
            able = scores + below[i] >= least
            docs, scores = docs[able], scores[able]
            if not len(docs):
                break
            theirs, parts = lists[i]
            at = np.minimum(np.searchsorted(theirs, docs), len(theirs) - 1)
            scores = scores + np.where(theirs[at] == docs, parts[at], 0)
        able = scores >= least
        if able.any():
            best = _top(np.concatenate([best[0], docs[able]]), np.concatenate([best[1], scores[able]]), k)
            if len(best[0]) == k:
                least = max(least, best[1][-1])
        low, width = high, 2 * width
    return best


def _weight(n_docs: int, df: Column) -> Column:
    return F.floor(1000 * F.log((F.lit(2 * n_docs + 2) / (2 * df + 1)).cast("double")))


def rank(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(item id, rank, document id, score): the k highest-scoring documents of every item, scores above 0 only.

    A term is a run of ASCII letters, digits and non-ASCII characters, A-Z without case. Its weight is floor(1000 *
    ln((2N + 2) / (2 df + 1))) over the N documents with a term; a document with n of all L terms has the length mark
    m = 50 + (50 * n * N) div L, and scores weight * ((10^9 * tf) div (1000 * tf + 20 * m)) for each distinct
    term of the item. Equal scores go to the smaller id, null ids last. Null and empty texts hold no term: such a
    document is never found, such an item finds nothing. Repeated rows are documents, and items, each. Whole
    texts are read; a very long one has no more postings than there are query terms. Other columns are not
    read; an empty table on either side gives an empty result.
    """
    id_kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    spoken = stage(with_terms(docs, id_col, text_col), "lexical-terms")
    asked = with_terms(items, item_col, item_text).select("row", "id", F.explode("terms").alias("term"))
    asked = stage(asked, "lexical-queries")
    n_docs, n_terms = spoken.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    asked_terms = asked.count()
    if not n_terms or not asked_terms:
        return docs.sparkSession.createDataFrame([], f"`{item_col}` {item_kind}, rank int, `{id_col}` {id_kind}, score long")
    words = stage(asked.select("term").distinct().withColumn("word", F.monotonically_increasing_id()), "lexical-words")
    pairs = spoken.select("row", "id", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("t")).select(
        "row", "id", "n", F.col("t.terms").alias("term"), F.col("t.tfs").alias("tf")
    )
    postings = stage(pairs.join(bounded(words, BROADCAST_ROWS), "term").select("word", "row", "id", "n", "tf"), "lexical-postings")
    counts = postings.groupBy("word").agg(F.count("*").alias("df"))
    groups = max(1, math.ceil(asked_terms / GROUP_TERMS))
    queries = asked.join(words, "term").select(
        "row", "id", "word", F.pmod(F.xxhash64("row"), F.lit(groups)).alias("team")
    )
    queries = stage(queries, "lexical-asked")
    weights = counts.select("word", _weight(n_docs, F.col("df")).alias("w")).where("w > 0")
    needed = stage(queries.select("word", "team").distinct().join(weights, "word"), "lexical-weights")
    total = postings.count()
    slices = max(1, math.ceil(total / SLICE))
    part = F.expr(
        f"w * ((1000000000L * tf) div (1000L * tf + 20L * (50L + (50L * n * {n_docs}L) div {n_terms}L)))"
    )
    dealt = (
        postings.join(bounded(needed, BROADCAST_ROWS), "word")
        .select("team", F.pmod(F.xxhash64("row"), F.lit(slices)).alias("slice"), "word", "row", "id", part.alias("part"))
        .where("part > 0")
    )
    copies = queries.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        # Documents in the order of ties: by id, null ids last, then by row.
        docs = right.select(["row", "id"]).take(pa.array(np.unique(right["row"].to_numpy(), return_index=True)[1]))
        docs = docs.take(pc.sort_indices(docs, sort_keys=[("id", "ascending"), ("row", "ascending")], null_placement="at_end"))
        by_row = np.argsort(docs["row"].to_numpy(), kind="stable")
        place = by_row[np.searchsorted(docs["row"].to_numpy()[by_row], right["row"].to_numpy())] if len(right) else np.empty(0, np.int64)
        order = np.lexsort((place, right["word"].to_numpy()))
        word, place, parts = right["word"].to_numpy()[order], place[order], right["part"].to_numpy()[order]
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.empty(0, np.int64)
        spans = {word[a]: slice(a, b) for a, b in zip(starts, [*starts[1:], len(word)])}
        wanted: dict[int, list] = {}
        ids = dict(zip(left["row"].to_pylist(), left["id"].to_pylist()))
        for row, term in zip(left["row"].to_pylist(), left["word"].to_pylist()):
            if term in spans:
                wanted.setdefault(row, []).append((place[spans[term]], parts[spans[term]]))
        found = {row: hybrid(lists, k) for row, lists in wanted.items()}
        at = np.concatenate([d for d, _ in found.values()]) if found else np.empty(0, np.int64)
        scores = np.concatenate([s for _, s in found.values()]) if found else np.empty(0, np.int64)
        query = [row for row, (d, _) in found.items() for _ in range(len(d))]
        hit = docs.take(pa.array(at, pa.int64()))
        return pa.table(
            {
                "item_row": pa.array(query, pa.int64()),
                "item": pa.array([ids[row] for row in query], left.schema.field("id").type),
                "row": hit["row"],
                "id": hit["id"],
                "score": pa.array(scores, pa.int64()),
            }
        )

    hits = (
        copies.select("team", "slice", "row", "id", "word")
        .groupBy("team", "slice")
        .cogroup(dealt.groupBy("team", "slice"))
        .applyInArrow(cell, f"item_row long, item {item_kind}, row long, id {id_kind}, score long")
    )
    order = Window.partitionBy("item_row").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
