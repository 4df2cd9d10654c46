"""Exact top-k search by inner product, over vectors sorted by length.

Vectors become fixed-point integers, so that scores are exact. An orthogonal rotation, the right singular
vectors of all rows, moves most of a vector's length into its first entries. Candidates are taken in
descending length; a query is done with a slice once its own length times the next candidate's is below its
k-th best score (Cauchy-Schwarz). Before that, inner products grow over a few widths of the rotated vectors,
and a pair is dropped as soon as its partial sum plus the product of the two residual lengths is below
the k-th best score. What is left is scored on the integers.

Queries are dealt into groups of bounded size by the length a candidate needs, candidates into slices of bounded
size by a hash of the row. A pair of group and slice is one task's work; candidates too short for all queries of a
group are not sent to it. Every query starts from its k-th best score among some of the longest vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import stage
from shelfcast.llm.vectors import LARGEST, fixed_point, usual_length

SEEDS = 4096
GROUP_BYTES = 64 << 20
SLICE_ROWS = 4096
CHUNK = 1024
PAIRS = 1 << 16
# Share of a row's length that rounding of the rotated vectors may move.
SLACK = 1e-9
MOST = 2**63 - 1


def _matrix(column: pa.ChunkedArray | pa.Array, length: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of integer rows, pair by pair; beyond 64 bits the largest or smallest long."""
    a, b = left.astype(np.float64), right.astype(np.float64)
    if (np.abs(a) * np.abs(b)).sum(axis=1).max(initial=0) < LARGEST:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    sums = (sum(x * y for x, y in zip(p, q)) for p, q in zip(left.tolist(), right.tolist()))
    return np.array([max(-MOST - 1, min(MOST, s)) for s in sums], dtype=np.int64)


class Best:
    """The k highest scores of each query so far; of equal ones those of the lowest places."""

    def __init__(self, least: np.ndarray, k: int) -> None:
        self.least, self.k = least.copy(), k
        self.query, self.place = np.empty(0, np.int64), np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)

    def add(self, query: np.ndarray, place: np.ndarray, score: np.ndarray) -> None:
        query, place, score = (np.concatenate(x) for x in ((self.query, query), (self.place, place), (self.score, score)))
        order = np.lexsort((place, -score.astype(object) if (score == -MOST - 1).any() else -score, query))
        query = query[order]
        start = np.r_[True, query[1:] != query[:-1]]
        rank = np.arange(len(query)) - np.maximum.accumulate(np.where(start, np.arange(len(query)), 0))
        top = rank < self.k
        self.query, self.place, self.score = query[top], place[order][top], score[order][top]
        last = rank[top] == self.k - 1
        self.least[self.query[last]] = np.maximum(self.least[self.query[last]], self.score[last].astype(np.float64))


def search(queries: np.ndarray, least: np.ndarray, rows: np.ndarray, same, rotation: np.ndarray, k: int) -> Best:
    """The k best rows of each query that reach its ``least`` score, ties to the lower row.

    ``same(i, j)`` tells the pairs (query, row) that are one and the same row.
    """
    best = Best(least, k)
    if not len(queries) or not len(rows):
        return best
    length = rows.shape[1]
    lengths = np.linalg.norm(rows.astype(np.float64), axis=1)
    own = np.linalg.norm(queries.astype(np.float64), axis=1)
    order = np.argsort(-lengths, kind="stable")
    turned, sought = rows[order].astype(np.float64) @ rotation, queries.astype(np.float64) @ rotation
    widths = sorted({max(1, length // 8), max(1, length // 4), max(1, length // 2), length})
    rest = [np.sqrt((turned[:, w:] ** 2).sum(axis=1)) for w in widths]
    left = [np.sqrt((sought[:, w:] ** 2).sum(axis=1)) for w in widths]
    for start in range(0, len(order), CHUNK):
        here = order[start : start + CHUNK]
        slack = SLACK * lengths[here[0]] * own
        alive = np.flatnonzero(own * lengths[here[0]] + slack >= best.least)
        if not len(alive):
            break  # the rows that follow are no longer than this one
        found = []
        for at in range(0, len(alive), CHUNK):
            block = alive[at : at + CHUNK]
            floor = (best.least[block] - slack[block])[:, None]
            sums, before, pairs = np.zeros((len(block), len(here))), 0, None
            for w, r, l in zip(widths, rest, left):
                if pairs is None:
                    sums += sought[block, before:w] @ turned[start : start + CHUNK, before:w].T
                    bound = sums + l[block][:, None] * r[start : start + CHUNK][None, :]
                    hit = bound >= floor
                    if w == length and len(here) > k:
                        # The k-th largest of this chunk, less what rounding may move, is a floor as well.
                        kth = np.partition(sums, -k - 1, axis=1)[:, -k - 1]
                        hit &= sums >= (kth - 2 * slack[block])[:, None]
                    if w == length or hit.sum() * 10 < hit.size:
                        i, j = np.nonzero(hit)
                        pairs = (i, j, sums[i, j])
                else:
                    i, j, s = pairs
                    s = s + np.einsum("ij,ij->i", sought[block[i], before:w], turned[start + j, before:w])
                    keep = s + l[block[i]] * r[start + j] >= floor[i, 0]
                    pairs = (i[keep], j[keep], s[keep])
                before = w
            found.append((block[pairs[0]], here[pairs[1]]))
        query, row = (np.concatenate(x) for x in zip(*found))
        other = ~same(query, row)
        query, row = query[other], row[other]
        for at in range(0, len(query), PAIRS):
            i, j = query[at : at + PAIRS], row[at : at + PAIRS]
            score = exact(queries[i], rows[j])
            keep = score >= best.least[i]
            if keep.any():
                best.add(i[keep], j[keep], score[keep])
    return best


def _prepared(vectors: DataFrame, is_query: Column, length: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(row, id, asks, x, norm) of the vectors that take part; ``row`` tells rows apart."""
    wanted = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.col(f"`{vector_col}`").alias("v"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = fixed_point(batch.column(3), length, scale)
            places = pa.array(at, pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * length, pa.int32()), pa.array(x.ravel()))
            norm = pa.array(np.linalg.norm(x.astype(np.float64), axis=1))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(places) for i in range(3)), lists, norm], names=["row", "id", "asks", "x", "norm"]
            )

    kind = wanted.schema["id"].dataType.simpleString()
    return wanted.mapInArrow(run, f"row long, id {kind}, asks boolean, x array<long>, norm double")


def rotation_of(rows: DataFrame, length: int) -> np.ndarray:
    """Right singular vectors of all rows, largest first: eigenvectors of the summed outer products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((length, length))
        for batch in batches:
            x = _matrix(batch.column(0), length).astype(np.float64)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["g"])

    sums = rows.select("x").mapInArrow(run, "g array<double>").select(F.posexplode("g")).groupBy("pos").agg(F.sum("col").alias("s"))
    flat = np.zeros(length * length)
    for row in sums.collect():  # the square of the vectors' length
        flat[row["pos"]] = row["s"]
    return np.linalg.eigh(flat.reshape(length, length))[1][:, ::-1].copy()


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, id, score): the k rows with the highest inner product for each row where ``is_query``.

    Entries become the integers floor(scale * entry); all rows but the query's own are candidates. Equal scores go
    to the smaller id, null ids last. Vectors that are null, hold null or non-finite entries, or entries of 2^53 and
    more at this scale, take no part, nor do those of another length than the most frequent one. A score beyond 64 bits is
    the largest or smallest long. Repeated rows are candidates, and queries, each. A query with fewer than k other
    rows returns them all. Other columns are not read; a table without vectors gives an empty result.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    length = usual_length(vectors, vector_col)
    if not length:
        return spark.createDataFrame([], f"query_id {kind}, rank int, `{id_col}` {kind}, score long")
    rows = stage(_prepared(vectors, is_query, length, scale, id_col, vector_col), "search-rows")
    n, asked = rows.agg(F.count("*"), F.count_if("asks")).first()
    rotation = rotation_of(rows, length)
    # Some of the longest vectors; any rows would do, since they only give a first bound.
    cut = rows.agg(F.percentile_approx("norm", max(0.0, 1 - SEEDS / max(n, 1)))).first()[0]
    seeds = rows.where(F.col("norm") >= F.lit(cut)).select("row", "x").limit(SEEDS).collect()
    shared = spark.sparkContext.broadcast(
        (np.array([r["row"] for r in seeds], np.int64), np.array([r["x"] for r in seeds], np.int64).reshape(-1, length), rotation)
    )

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest, x, turn = shared.value
        for batch in batches:
            own, mine = batch.column(0).to_numpy(), _matrix(batch.column(2), length)
            best = search(mine, np.full(len(mine), -np.inf), x, lambda i, j: own[i] == longest[j], turn, k)
            least = pa.array(best.least)
            with np.errstate(all="ignore"):
                need = best.least / batch.column(3).to_numpy()
            need = np.where(np.isfinite(need) & (best.least > 0), need, -1.0)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), least, pa.array(need)], names=["row", "id", "x", "least", "need"])

    schema = f"row long, id {kind}, x array<long>, least double, need double"
    queries = rows.where("asks").select("row", "id", "x", "norm").mapInArrow(seed, schema)
    groups = max(1, math.ceil(asked * length * 8 / GROUP_BYTES))
    if groups > 1:
        queries = queries.repartitionByRange(groups, "need", "row").withColumn("team", F.spark_partition_id())
    else:
        queries = queries.withColumn("team", F.lit(0))
    queries = stage(queries, "search-queries")
    teams = queries.groupBy("team").agg(F.min("need").alias("need")).collect()  # one row for each 64 MB of queries
    slices = max(1, math.ceil(n / max(SLICE_ROWS, 4 * asked // groups)))
    needs = F.array(*(F.struct(F.lit(t["team"]).alias("team"), F.lit(t["need"]).alias("need")) for t in teams)) if teams else F.array()
    reached = F.filter(needs, lambda t: F.col("norm") * (1 + SLACK) >= t["need"]) if teams else needs
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(slices)))
    if not teams:
        return spark.createDataFrame([], f"query_id {kind}, rank int, `{id_col}` {kind}, score long")
    dealt = dealt.withColumn("team", F.explode(F.transform(reached, lambda t: t["team"]))).select("team", "part", "row", "id", "x")
    copies = queries.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        turn = shared.value[2]
        # Rows in the order of ties: by id, null ids last, then by row.
        place = pc.sort_indices(right, sort_keys=[("id", "ascending"), ("row", "ascending")], null_placement="at_end")
        right = right.take(place)
        own, theirs = left["row"].to_numpy(), right["row"].to_numpy()
        asking, x = _matrix(left["x"], length), _matrix(right["x"], length)
        best = search(asking, left["least"].to_numpy(), x, lambda i, j: own[i] == theirs[j], turn, k)
        query, found = left.take(pa.array(best.query)), right.take(pa.array(best.place))
        return pa.table(
            {"query_row": query["row"], "query_id": query["id"], "row": found["row"], "id": found["id"], "score": pa.array(best.score, pa.int64())}
        )

    hits = (
        copies.select("team", "part", "row", "id", "x", "least")
        .groupBy("team", "part")
        .cogroup(dealt.groupBy("team", "part"))
        .applyInArrow(cell, f"query_row long, query_id {kind}, row long, id {kind}, score long")
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
