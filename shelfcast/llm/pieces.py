"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The model compiles to three parts. The normaliser rewrites its input by the longest rule that fits at each
place, from left to right, user-defined pieces untouched, and writes a space as the meta symbol, with one in front. The
piece part has an arc for each vocabulary piece, from its characters to its id, and the byte fallback
an arc from any character that no piece covers to the ids of its bytes. The weights live in the tropical
semiring: paths add, alternatives take the minimum. A unigram model weighs an arc by its negated score.
A BPE model has no weight of its own: there the link between neighbouring pieces is weighted, 0 if merging
the two pieces' characters by rank gives back these two pieces, else infinity. A sequence of pieces is the
result of the merges exactly if all its links are free, so one path of finite weight is left. A user-defined
piece takes no part in merges: it cuts the text. In a unigram model it outweighs all other paths over its characters.

Composing with an input gives a lattice over its positions, and the shortest path is found in one sweep.
Since the last piece of the best path to a position is unique, positions are the only states.

No piece holds a meta symbol behind another character, so lattices are cut there, and where no piece holds a letter
and another character, between these. The paths of frequent chunks are remembered in a bounded table.
"""

from __future__ import annotations

import codecs
import math
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from shelfcast.llm.common import text_batches

META = "▁"
# Word characters but digits, Latin-1's raised ones and fractions; and all the others.
NO_LETTER = r"\d_\xb2\xb3\xb9\xbc-\xbe"
LETTER, OTHER = rf"[^\W{NO_LETTER}]", rf"[\W{NO_LETTER}]"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
# A chunk table holds at most twice as many chunks, and none longer than this.
TABLE = 150_000
TABLE_CHARS = 64
UNKNOWN_PENALTY = 10.0
USER_PENALTY = 0.1
# Remembered links between pieces.
LINKS = 1 << 20
INFINITY = math.inf
NOWHERE, START = -2, -1


def _one_by_one(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("replace-each", _one_by_one)


def compile_charsmap(blob: bytes) -> dict[str, str]:
    """The rewriting rules of a precompiled character map, from source to target.

    The map holds the size of a double-array trie over UTF-8, the trie in words of 32 bits, and the targets, each ended
    by a zero byte. All states of one depth are followed over all byte labels at once.
    """
    size = int.from_bytes(blob[:4], "little")
    if len(blob) < 4 or size % 4 or not 0 < size <= len(blob) - 4:
        raise ValueError("the character map is damaged")
    units = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64)
    targets = blob[4 + size :]
    below = lambda unit: (unit >> 10) << ((unit & 1 << 9) >> 6)
    labels = np.arange(1, 256)
    rules: dict[str, str] = {}
    states, sources = np.zeros(1, np.int64) ^ below(units[:1]), [b""]
    while len(states):
        places = states[:, None] ^ labels
        known = places < len(units)
        found = units[np.where(known, places, 0)]
        rows, columns = np.nonzero(known & ((found & 0x800000FF) == labels))
        units_there, places = found[rows, columns], places[rows, columns]
        sources = [sources[row] + bytes([label]) for row, label in zip(rows.tolist(), labels[columns].tolist())]
        states = places ^ below(units_there)
        for i in np.nonzero(units_there & 1 << 8)[0].tolist():
            start = int(units[states[i]] & 0x7FFFFFFF)
            rules[sources[i].decode()] = targets[start : targets.index(b"\0", start)].decode()
    return rules


def _one_of(characters) -> str:
    """Pattern of a character class, neighbouring code points as a range; of nothing, if there are none."""
    codes = sorted(map(ord, characters))
    if not codes:
        return "(?!)"
    ranges: list[list[int]] = []
    for code in codes:
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(rf"\U{a:08X}-\U{b:08X}" for a, b in ranges) + "]"


class Normaliser:
    """The rewriting part of a model, with its white-space rules."""

    def __init__(self, spec: proto.NormalizerSpec, users: list[str]) -> None:
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.rules = compile_charsmap(spec.precompiled_charsmap) if spec.precompiled_charsmap else {}
        self.reach: dict[str, int] = {}
        for source in self.rules:
            self.reach[source[0]] = max(len(source), self.reach.get(source[0], 0))
        # Where a rule may fit: its first character if it is the only one, else a character before some second one.
        single = _one_of({source for source in self.rules if len(source) == 1})
        second = _one_of({source[1] for source in self.rules if len(source) > 1})
        own = "|".join(map(re.escape, sorted(users, key=len, reverse=True))) or "(?!)"
        self.places = re.compile(f"({own})|{single}|.(?={second})", re.DOTALL)
        self.identity = not self.rules and not users

    def parts(self, text: str) -> Iterator[tuple[bool, str]]:
        """The text in order, as runs that no rule touches (False) and as rule targets and user-defined pieces (True)."""
        rules, done, at = self.rules, 0, 0
        while found := self.places.search(text, at):
            at = found.start()
            if found[1]:
                size, target = len(found[1]), found[1]
            else:
                reach = self.reach.get(text[at], 0)
                size = next((n for n in range(min(reach, len(text) - at), 0, -1) if text[at : at + n] in rules), 0)
                target = rules.get(text[at : at + size], "")
            if size:
                if done < at:
                    yield False, text[done:at]
                yield True, target
                done = at + size
            at += size or 1
        if done < len(text):
            yield False, text[done:]

    def __call__(self, text: str) -> str:
        if not text:
            return text
        if not self.squeeze:
            if not self.identity:
                text = "".join(part for _, part in self.parts(text))
            return META * self.prefix + text.replace(" ", META)
        out, spaced = [], True  # nothing but spaces so far counts as a space in front
        for whole, part in self.parts(text):
            if not whole:
                part = re.sub(" +", " ", part)
            if spaced:
                part = part.lstrip(" ")
            if part:
                out.append(part)
                spaced = part.endswith(" ")
        text = "".join(out).replace(" ", META)
        return (META * self.prefix + text).rstrip(META)


class Transducer:
    """Encoder and decoder of one serialised model."""

    def __init__(self, model: bytes) -> None:
        spec = proto.ModelProto()
        spec.ParseFromString(model)
        if not spec.normalizer_spec.escape_whitespaces or spec.denormalizer_spec.precompiled_charsmap:
            raise ValueError("plain spaces in pieces and rewriting after decoding are not supported")
        if spec.trainer_spec.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        if spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("white space as a suffix is not supported")
        self.merges = spec.trainer_spec.model_type == BPE
        if self.merges and any(piece.type == UNUSED for piece in spec.pieces):
            raise ValueError("unused pieces of a BPE model are not supported")
        users = [piece.piece for piece in spec.pieces if piece.type == USER]
        self.normalise = Normaliser(spec.normalizer_spec, users)
        self.prefix, self.squeeze = self.normalise.prefix, self.normalise.squeeze
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        self.output: list[bytes] = []
        self.silent: set[int] = set()
        self.spaced: set[int] = set()
        self.unknown = spec.trainer_spec.unk_id
        for i, piece in enumerate(spec.pieces):
            if piece.type == BYTE:
                value = int(piece.piece[3:-1], 16)
                self.bytes[value] = i
                self.output.append(bytes([value]))
                continue
            if piece.type in (NORMAL, USER):
                self.ids[piece.piece] = i
            if piece.type == NORMAL:
                self.scores[piece.piece] = piece.score
            text = {UNKNOWN: " ⁇ ", CONTROL: ""}.get(piece.type, piece.piece.replace(META, " "))
            self.output.append(text.encode())
            if piece.type == CONTROL:
                self.silent.add(i)
            elif piece.type != UNKNOWN and piece.piece.startswith(META):
                self.spaced.add(i)
        self.longest = max(map(len, self.ids), default=1)
        self.worst = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        most = max(self.scores.values(), default=0.0)
        self.user = None
        if users and self.merges:
            self.user = re.compile("(" + "|".join(map(re.escape, sorted(users, key=len, reverse=True))) + ")")
        for piece in users:
            self.scores[piece] = len(piece.encode()) * most - USER_PENALTY
        inner = any(META in p.lstrip(META) for p in self.ids)
        # Cuts stand before meta symbols, and around line ends where no piece has one.
        cut = "" if any("\n" in p for p in self.ids) else "\n"
        body = f"[^{META}{cut}]+"
        # And where letters meet other characters, if no piece has both. Without byte fallback unknown neighbours are one piece.
        if self.bytes and all(re.fullmatch(f"{META}*(?:{LETTER}*|{OTHER}*)", p) for p in self.ids):
            body = rf"(?:{LETTER}++|(?:[{NO_LETTER}]++|[^\w{META}{cut}]++)++)"
        self.chunks = re.compile(".+" if inner else f"{META}*{body}|{META}+" + "|\n" * bool(cut), re.DOTALL)
        self.arcs = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.arcs.add_word(piece, (len(piece), i))
        self.arcs.make_automaton()
        self.names = {i: piece for piece, i in self.ids.items()}
        self.free: dict[int, bool] = {}
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    # --- the parts ------------------------------------------------------------------------

    def surface(self, text: str) -> str:
        """What decoding the ids of a text gives, if no character is unknown: the normalised text, in spaces."""
        if self.normalise.identity and not self.squeeze:
            return text.replace(META, " ")
        text = self.normalise(text)
        if self.squeeze:
            return text.lstrip(META).replace(META, " ")
        return text[self.prefix :].replace(META, " ")

    def merged(self, text: str) -> list[str]:
        """The pieces that merging by score, leftmost first, leaves of a short text."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = -INFINITY, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1], -INFINITY)
                if score > best:
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def link(self, left: str, right: str) -> float:
        """Weight between two pieces; with nothing on the left, of the right one by itself."""
        if not self.merges:
            return 0.0
        pair = [left, right] if left else [right]
        return 0.0 if self.merged(left + right) == pair else INFINITY

    def _is_free(self, key: int, left: int, right: int) -> bool:
        """Whether the link between two ids is free, remembered; ``START`` stands for nothing."""
        if len(self.free) >= LINKS:
            self.free.clear()
        name = "" if left == START else self.names[left]
        found = self.free[key] = self.link(name, self.names[right]) < INFINITY
        return found

    def arc(self, piece: str) -> float:
        """Weight of a piece, or of the fallback for a character without one."""
        if self.merges:
            return 0.0
        return -self.scores.get(piece, self.worst)

    # --- composition and shortest path ------------------------------------------------------

    def merge_path(self, text: str) -> list[int] | None:
        """Ids on the free path of a BPE model; None if only the byte fallback gets through.

        The automaton of the pieces reports the arcs into each position, the longest first. At most one
        of them has a free link to the path behind it.
        """
        last = [NOWHERE] * (len(text) + 1)
        last[0] = START
        taken = [0] * (len(text) + 1)
        free = self.free
        for end, (length, piece) in self.arcs.iter(text):
            end += 1
            before = last[end - length]
            if before == NOWHERE or last[end] != NOWHERE:
                continue
            key = before << 32 | piece
            found = free.get(key)
            if found is None:
                found = self._is_free(key, before, piece)
            if found:
                last[end], taken[end] = piece, length
        at, out = len(text), []
        if last[at] == NOWHERE:
            return None
        while at:
            out.append(last[at])
            at -= taken[at]
        return out[::-1]

    def path(self, text: str) -> list[str]:
        """Pieces on the shortest path through the lattice of a normalised text."""
        ids, link, merges = self.ids, self.link, self.merges
        best = [0.0] + [INFINITY] * len(text)
        last = [""] * (len(text) + 1)
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - self.longest), end):
                piece = text[start:end]
                if best[start] < INFINITY and (piece in ids or end - start == 1):
                    weight = best[start] + self.arc(piece) + link(last[start], piece)
                    if weight < best[end]:
                        best[end], last[end] = weight, piece
                        if merges:
                            break  # the only one of finite weight
        pieces, at = [], len(text)
        while at:
            pieces.append(last[at])
            at -= len(last[at])
        return pieces[::-1]

    def _ids(self, chunk: str) -> tuple[int, ...]:
        if self.merges and (found := self.merge_path(chunk)) is not None:
            return tuple(found)
        out: list[int] = []
        for piece in self.path(chunk):
            if piece in self.ids:
                out.append(self.ids[piece])
            elif self.bytes:
                out += [self.bytes[b] for b in piece.encode("utf-8", "replace")]
            elif not out or out[-1] != self.unknown:  # neighbouring unknown characters are one piece
                out.append(self.unknown)
        return tuple(out)

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        found = self.old.get(chunk)
        if found is None:
            found = self._ids(chunk)
        if len(chunk) <= TABLE_CHARS:
            if len(self.young) >= TABLE:
                self.old, self.young = self.young, {}
            self.young[chunk] = found
        return found

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text."""
        text = self.normalise(text)
        if self.user is None:
            return self._encode(text)
        out: list[int] = []
        for i, part in enumerate(self.user.split(text)):
            out += [self.ids[part]] if i % 2 else self._encode(part)
        return out

    def _encode(self, text: str) -> list[int]:
        out: list[int] = []
        young = self.young
        for chunk in self.chunks.findall(text):
            found = young.get(chunk)
            if found is None:
                found = self._chunk(chunk)
                young = self.young
            out += found
        return out

    def decode(self, ids) -> str:
        """The text of ids: their pieces in a row, without the space in front that encoding added.

        Where the model removes extra white space, every piece loses its space as long as there is no text in front.
        """
        ids = list(ids)
        if self.squeeze:
            dropped, meta = 0, self.ids.get(META)
            while dropped < len(ids) and (ids[dropped] in self.silent or ids[dropped] == meta):
                dropped += 1
            ids = ids[dropped:]
        text = self._joined(ids)
        first = next((i for i in ids if i not in self.silent), None)
        return text[1:] if (self.prefix or self.squeeze) and first in self.spaced else text

    def _joined(self, ids: list[int]) -> str:
        """The output of ids in a row; the bytes on either side of a control piece make no character together."""
        runs: list[list[bytes]] = [[]]
        if self.silent.isdisjoint(ids):
            runs[0] = [self.output[i] for i in ids]
        else:
            for i in ids:
                if i in self.silent:
                    runs.append([])
                else:
                    runs[-1].append(self.output[i])
        return "".join(b"".join(run).decode("utf-8", "replace-each") for run in runs)


_loaded: dict[bytes, Transducer] = {}


def load(model: bytes) -> Transducer:
    """The transducer of a model, compiled once in a process."""
    if model not in _loaded:
        _loaded.clear()
        _loaded[model] = Transducer(model)
    return _loaded[model]


def read_model(path: str) -> bytes:
    """A model file from the driver's file system; the tasks get its content."""
    with open(path, "rb") as handle:
        return handle.read()


def _id_lists(lists: list[list[int] | None]) -> pa.Array:
    sizes = np.array([0 if x is None else len(x) for x in lists], dtype=np.int32)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    values = np.fromiter((i for x in lists if x for i in x), dtype=np.int32, count=int(offsets[-1]))
    missing = pa.array([x is None for x in lists], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=missing)


def encode(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", verify: bool = False
) -> DataFrame:
    """Ids of every text: (id, ids array<int>, n_tokens), with ``verify`` also ``round_trip``.

    ``round_trip`` says whether the decoded ids give the normalised text again (with the identity the text
    itself), a meta symbol in it read as the space it stands for. A null text has null ids, 0 tokens and a null ``round_trip``; an empty text no ids.
    Whole texts are encoded, however long, chunk by chunk. Repeated rows are encoded each; columns other than
    the two named are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    text_batches(spark)
    model = spark.sparkContext.broadcast(read_model(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = load(model.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids = [None if t is None else transducer.encode(t) for t in texts]
            out = [batch.column(0), _id_lists(ids), pa.array([0 if x is None else len(x) for x in ids], pa.int64())]
            names = [id_col, "ids", "n_tokens"]
            if verify:
                same = [None if t is None else transducer.decode(x) == transducer.surface(t) for t, x in zip(texts, ids)]
                out.append(pa.array(same, pa.bool_()))
                names.append("round_trip")
            yield pa.RecordBatch.from_arrays(out, names=names)

    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, ids array<int>, n_tokens long" + ", round_trip boolean" * verify
    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids in column ``out``; null ids give a null text."""
    model = encoded.sparkSession.sparkContext.broadcast(read_model(model_path))

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        transducer = load(model.value)
        return pd.Series([None if x is None else transducer.decode(x) for x in ids], dtype=object)

    return encoded.withColumn(out, text(F.col(f"`{ids_col}`")))
