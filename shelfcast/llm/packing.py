"""Token ids packed into fixed-length rows, for training.

Texts become token ids with an end mark. A document longer than a row is cut into pieces of a row's length
and a rest; nothing is lost. The pieces are stored, then dealt into buckets of a bounded number of ids by a hash
of their row number, and each bucket is packed by itself with best-fit decreasing: pieces from long to short, each into the
row with the least room that still holds it. The row is found in a segment tree over room sizes, whose nodes
say whether any open row has such room.

A packed row holds its ids as little-endian 16- or 32-bit integers, padded to full length, the cumulative
lengths of its segments, and the offsets at which positions start again: a document's first piece
starts from 0, a later piece goes on from where the one before it ended.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import stage, text_batches

ROW = 2048
BUCKET_IDS = 1 << 20
# A longer run of white space is kept from the pattern, which uses stack for each of its characters.
LONG_SPACE = 1000
# Fixed value: how text is split before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Rooms:
    """Open rows by the room left in them: a segment tree over 0 to ``size`` units."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << (size + 1).bit_length()
        self.any = bytearray(2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def _mark(self, room: int, on: int) -> None:
        node = room + self.leaves
        self.any[node] = on
        while node > 1:
            node >>= 1
            now = self.any[2 * node] | self.any[2 * node + 1]
            if self.any[node] == now:
                break
            self.any[node] = now

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        if len(self.rows[room]) == 1:
            self._mark(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The row with the least room of at least ``need``, taken out: (room, row)."""
        node = need + self.leaves
        if not self.any[node]:
            # Up to the first right neighbour that has something, then down its left edge.
            while node > 1 and (node & 1 or not self.any[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        room = node - self.leaves
        row = self.rows[room].pop()
        if not self.rows[room]:
            self._mark(room, 0)
        return room, row


def best_fit(lengths: list[int], size: int) -> list[int]:
    """The row of each piece; ``lengths`` are at most ``size`` and in descending order."""
    rooms, rows, out = Rooms(size), 0, []
    for length in lengths:
        found = rooms.take(length)
        if found is None:
            found, rows = (size, rows), rows + 1
        room, row = found
        out.append(row)
        if room > length:
            rooms.add(room - length, row)
    return out


class RankEncoder:
    """Encoder of a rank file of byte-level BPE: read on the driver, built once in a process."""

    def __init__(self, path: str, long_space: int = LONG_SPACE) -> None:
        with open(path, "rb") as handle:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, handle)}
        self.largest = max(self.ranks.values())
        self.long_space = long_space
        self.coder = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"coder": None}

    def __call__(self, texts: list[str]) -> list[list[int]]:
        if self.coder is None:
            import tiktoken

            self.coder = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        return [self._encode(t) for t in texts]

    def _encode(self, text: str) -> list[int]:
        """Ids of a text. In a long run of white space the pattern matches all but the last character as one word, or
        all of them at the end of a text; such a word is merged by itself, without the pattern."""
        if len(text) <= self.long_space:
            return self.coder.encode_ordinary(text)
        ids, at = [], 0
        for run in regex.finditer(rf"\p{{White_Space}}{{{self.long_space},}}", text):
            last = run.end() if run.end() == len(text) else run.end() - 1
            ids += self.coder.encode_ordinary(text[at : run.start()])
            ids += self.coder._encode_single_piece(text[run.start() : last])
            at = last
        return ids + self.coder.encode_ordinary(text[at:])


def width(encoder, end: int, wide: bool | None) -> str:
    """Integer type of the ids: 32 bits if asked for, or if the encoder's ``largest`` id, or ``end``, needs them."""
    if wide is None:
        wide = max(getattr(encoder, "largest", 1 << 16), end) >= 1 << 16
    return "<u4" if wide else "<u2"


def pieces(
    docs: DataFrame,
    encoder: Callable[[list[str]], list[list[int]]],
    end: int,
    row: int = ROW,
    id_col: str = "doc_id",
    text_col: str = "text",
    wide: bool | None = None,
) -> DataFrame:
    """(id, part, at, length, ids binary, nr): the token ids of each text and ``end``, cut at ``row`` ids.

    ``nr`` tells rows of the input apart. An id that does not fit the integers of ``width`` fails the job.
    """
    text_batches(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").cast("string").alias("text"), F.monotonically_increasing_id().alias("nr")
    )
    shared = docs.sparkSession.sparkContext.broadcast(encoder)
    kind = width(encoder, end, wide)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = shared.value
        for batch in batches:
            doc, part, at, size, data = [], [], [], [], []
            for i, ids in enumerate(encode([t or "" for t in batch.column(1).to_pylist()])):
                whole = np.array([*ids, end], dtype=np.int64)
                if whole.max() > np.iinfo(kind).max or whole.min() < 0:
                    raise ValueError(f"token id {whole.max()} does not fit {kind}")
                whole = whole.astype(kind)
                for k, start in enumerate(range(0, len(whole), row)):
                    cut = whole[start : start + row]
                    doc.append(i)
                    part.append(k)
                    at.append(start)
                    size.append(len(cut))
                    data.append(cut.tobytes())
            places = pa.array(doc, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(places),
                    pa.array(part, pa.int32()),
                    pa.array(at, pa.int64()),
                    pa.array(size, pa.int32()),
                    pa.array(data, pa.binary()),
                    batch.column(2).take(places),
                ],
                names=[id_col, "part", "at", "length", "ids", "nr"],
            )

    id_type = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, part int, at long, length int, ids binary, nr long")


def pack(
    docs: DataFrame,
    encoder: Callable[[list[str]], list[list[int]]],
    end: int,
    row: int = ROW,
    id_col: str = "doc_id",
    text_col: str = "text",
    wide: bool | None = None,
) -> DataFrame:
    """Packed rows: (bucket, row, doc_ids, parts, starts, cu_seqlens, ids binary).

    ``ids`` holds ``row`` integers, padded with ``end``: of 32 bits if ``wide``, of 16 if not, and by default of as many as
    the encoder's ``largest`` id needs (32 if it names none). An id that does not fit fails the job. Segment i
    of a row is ``ids[cu_seqlens[i]:cu_seqlens[i + 1]]``, part ``parts[i]`` of document ``doc_ids[i]``; positions
    in it count up from ``starts[i]``. Null and empty texts are a single end mark. A very long text is cut
    into as many parts as it needs. Repeated rows are packed each, spread over the buckets like any others; ids may be
    null. Columns other than the two named are not read. An empty table gives an empty result.
    """
    cut = stage(pieces(docs, encoder, end, row, id_col, text_col, wide), "pieces")
    size = cut.agg(F.sum("length")).first()[0] or 0
    buckets = max(1, math.ceil(size / BUCKET_IDS))
    # The row number spreads rows that are equal in all else.
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("nr", "part"), F.lit(buckets)))
    kind = width(encoder, end, wide)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "nr", "part"], ascending=[False, True, True], kind="stable")
        rows: dict[int, list] = {}
        places = best_fit(frame["length"].tolist(), row)
        for place, *piece in zip(places, frame[id_col], frame["part"], frame["at"], frame["ids"]):
            rows.setdefault(place, []).append(piece)
        out = []
        for place, held in rows.items():
            parts = [np.frombuffer(x[3], dtype=kind) for x in held]
            cuts = np.cumsum([0, *map(len, parts)])
            matrix = np.full(row, end, dtype=kind)
            matrix[: cuts[-1]] = np.concatenate(parts)
            ids = [None if pd.isna(x[0]) else x[0] for x in held]
            out.append((frame["bucket"].iloc[0], place, ids, [x[1] for x in held], [x[2] for x in held], cuts, matrix.tobytes()))
        return pd.DataFrame(out, columns=["bucket", "row", "doc_ids", "parts", "starts", "cu_seqlens", "ids"])

    id_type = cut.schema[id_col].dataType.simpleString()
    return dealt.groupBy("bucket").applyInPandas(
        run,
        f"bucket long, row int, doc_ids array<{id_type}>, parts array<int>, starts array<long>, "
        "cu_seqlens array<int>, ids binary",
    )


def positions(starts: np.ndarray, cu_seqlens: np.ndarray) -> np.ndarray:
    """Position of every id in the segments of a row."""
    lengths = np.diff(cu_seqlens)
    return np.arange(cu_seqlens[-1]) - np.repeat(cu_seqlens[:-1] - np.asarray(starts), lengths)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet, a file or more for each bucket range; ``ids`` is the matrix row."""
    packed.write.mode("overwrite").parquet(path)
