"""Exact SentencePiece encoding of merge-type models by backtracking, and decoding.

Merging always takes the best-scored pair of neighbours, the left one first. A sequence of pieces is what merging
gives if and only if merging each two neighbours alone gives these two. So a text is encoded by taking the longest piece at each
place (an Aho-Corasick automaton lists them), trying shorter ones while a piece does not go with the one before,
and going back where none does; a bitfield marks places that no encoding passes. Two neighbours are checked by merging them
again from their recorded merges. Texts are cut before runs of the white-space sign, over which no piece reaches.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"
CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*")
MARKS = ".,;:!?|"  # after words; cut off where no piece joins them to the word
ROWS = 250  # texts in a batch that a task hands on
HELD_CHUNKS = 80_000  # chunks in each of the two tables that a task remembers
HELD_PAIRS = 160_000
UNKNOWN_SURFACE = " ⁇ "
IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))
#: What a model must do as the library does it: keep white space, put a sign in front, fall back to bytes.
PROBES = ("", " ", "  a  b ", "a\tb\n", "ﬁéé", "\U0001f600\u0001", f"{SPACE}a")


@dataclass
class Model:
    """Pieces of a merge-type model; ``scores`` has the pieces that merging can give."""

    pieces: list[str]
    kinds: list[str]  # normal, byte, control, unknown, unused
    scores: dict[str, float]
    whole: list[str]  # pieces that merging their own characters gives

    def plain(self) -> tuple:
        """What is sent to the tasks, without this class."""
        return self.pieces, self.kinds, self.scores, self.whole


def recorded_merges(text: str, scores: dict[str, float]) -> tuple[list[tuple[float, str, str]], list[str]]:
    """The merges of a text alone, in order, and what they give: (rank, first symbol after it, last symbol after it)."""
    symbols, merges = list(text), []
    while True:
        best, at = float("-inf"), -1
        for i in range(len(symbols) - 1):
            score = scores.get(symbols[i] + symbols[i + 1])
            if score is not None and score > best:
                best, at = score, i
        if at < 0:
            return merges, symbols
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        merges.append((-best, symbols[0], symbols[-1]))


def load(path: str) -> Model:
    """Read a model file on the driver; its pieces are sent to the tasks."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    ids = range(sp.get_piece_size())
    pieces = [sp.id_to_piece(i) for i in ids]
    kinds = [
        "unknown" if sp.is_unknown(i) else "control" if sp.is_control(i) else "byte" if sp.is_byte(i)
        else "unused" if sp.is_unused(i) else "normal" for i in ids
    ]
    if kinds.count("byte") != 256 or "unused" in kinds:
        raise ValueError("only models with byte pieces and without unused pieces are supported")
    scores = {p: sp.get_score(i) for i, p in enumerate(pieces) if kinds[i] == "normal"}
    if any(SPACE in p.lstrip(SPACE) for p in scores):
        raise ValueError("a piece reaches over a word's end")
    model = Model(pieces, kinds, scores, [p for p in scores if len(recorded_merges(p, scores)[1]) == 1])
    encode, decode = Encoder(model), Decoder(model)
    for text in PROBES:
        if encode(text).tolist() != (ids := sp.encode(text)) or decode(ids) != sp.decode(ids):
            raise ValueError("the model normalises texts in a way that is not supported")
    return model


class Encoder:
    """Ids of whole texts. Remembers the ids of chunks and the answers for pairs, up to fixed numbers of each."""

    def __init__(self, model: Model):
        import ahocorasick

        self.scores = model.scores
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for piece in model.whole:
            self.automaton.add_word(piece)
        self.automaton.make_automaton()
        self.whole = set(model.whole)
        self.longest = max(map(len, model.whole), default=1)
        #: The next shorter piece that a piece begins with; its first character, a piece or not, is the last.
        self.shorter = {
            p: next((p[:n] for n in range(len(p) - 1, 1, -1) if p[:n] in self.whole), p[0]) for p in model.whole if len(p) > 1
        }
        self.ids = {p: i for i, p in enumerate(model.pieces) if model.kinds[i] == "normal"}
        self.byte_ids = [i for i, kind in enumerate(model.kinds) if kind == "byte"]
        self.line = self._bytes("\n")
        self.written = {p: np.int32(i).tobytes() for p, i in self.ids.items()}
        #: Ids by chunk without its sign: a full table becomes the earlier one, and what is still used moves to the new one.
        self.recent: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}  # ids of what has no sign before it, as after a line break
        self.pairs: dict[tuple[str, str], bool] = {}
        self.merges: dict[str, list[tuple[float, str, str]]] = {}
        #: Neighbours inside some piece; between any other two characters a text can be cut.
        self.met = {pair for piece in model.scores for pair in zip(piece, piece[1:], strict=False)}

    def _merges(self, piece: str) -> list[tuple[float, str, str]]:
        found = self.merges.get(piece)
        if found is None:
            found = self.merges[piece] = recorded_merges(piece, self.scores)[0]
        return found

    def _bytes(self, text: str) -> bytes:
        return np.array([self.byte_ids[b] for b in text.encode()], dtype=np.int32).tobytes()

    def fits(self, left: str, right: str) -> bool:
        """True when merging ``left + right`` ends with these two: no merge across the border comes first."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= HELD_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self._fits(left, right)
        return known

    def _fits(self, left: str, right: str) -> bool:
        before, after, a, b, i, j = self._merges(left), self._merges(right), left[-1], right[0], 0, 0
        never = float("inf")
        while True:
            across = self.scores.get(a + b)
            across = never if across is None else -across
            own = before[i][0] if i < len(before) else never
            next_own = after[j][0] if j < len(after) else never
            if across < own and across <= next_own:
                return False
            if own is never and next_own is never:
                return True
            if own <= next_own:
                a = before[i][2]
                i += 1
            else:
                b = after[j][1]
                j += 1

    def split(self, chunk: str) -> list[str]:
        """Pieces of a chunk; a character that no piece has stands alone."""
        size, failed = len(chunk), bytearray(len(chunk) // 8 + 1)
        stack: list[tuple[int, str, str | None]] = []
        at, before, piece = 0, None, None
        reach, longest, whole, shorter, known = self.automaton.longest_prefix, self.longest, self.whole, self.shorter, self.pairs.get
        while at < size:
            if piece is None:
                rest = chunk[at : at + longest]
                n = reach(rest) or 1
                piece = rest[:n]
                while n > 1 and piece not in whole:
                    n -= 1
                    piece = rest[:n]
            while piece is not None:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1:
                    if before is None:
                        break
                    fits = known((before, piece))
                    if self.fits(before, piece) if fits is None else fits:
                        break
                piece = shorter.get(piece)
            if piece is not None:
                stack.append((at, piece, before))
                before, at, piece = piece, end, None
            else:
                failed[at >> 3] |= 1 << (at & 7)
                at, piece, before = stack.pop()
                # None after the last choice: the place before it fails as well.
                piece = shorter.get(piece)
                while piece is None and stack:
                    failed[at >> 3] |= 1 << (at & 7)
                    at, piece, before = stack.pop()
                    piece = shorter.get(piece)
        return [piece for _, piece, _ in stack]

    def chunk(self, chunk: str) -> bytes:
        """Ids of a chunk as 32-bit integers."""
        if chunk[0] != SPACE:
            found = self.bare.get(chunk)
            if found is None:
                if len(self.bare) >= HELD_CHUNKS:
                    self.bare.clear()
                found = self.bare[chunk] = self._chunk(chunk)
            return found
        word = chunk[1:]
        found = self.recent.get(word)
        if found is None:
            found = self.earlier.get(word)
            if found is None:
                if "\n" in word and "\n" not in self.ids:
                    return self._chunk(chunk)
                found = self._chunk(chunk)
            if len(self.recent) >= HELD_CHUNKS:
                self.recent, self.earlier = {}, self.recent
            self.recent[word] = found
        return found

    def _chunk(self, chunk: str) -> bytes:
        # A line break is in no piece, so what lies between is encoded by itself.
        if "\n" in chunk and len(chunk) > 1 and "\n" not in self.ids:
            return self.line.join([self.chunk(p) if p else b"" for p in chunk.split("\n")])
        core = chunk.rstrip(MARKS)
        if core and len(core) < len(chunk) and (core[-1], chunk[len(core)]) not in self.met:
            found = self.chunk(core) + self.chunk(chunk[len(core) :])
        else:
            known = self.written.get
            found = b"".join([known(p) or self._bytes(p) for p in self.split(chunk)])
        return found

    def raw(self, text: str) -> bytes:
        if not text:
            return b""
        chunk = self.chunk
        if SPACE in text or "  " in text or text[0] == " " or text[-1] == " ":
            return b"".join([chunk(c) for c in CHUNK.findall(SPACE + text.replace(" ", SPACE))])
        return b"".join([self.recent.get(w) or chunk(SPACE + w) for w in text.split(" ")])

    def __call__(self, text: str) -> np.ndarray:
        return np.frombuffer(self.raw(text), dtype=np.int32)


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


class Decoder:
    """Text of ids; the white-space sign that encoding put in front is taken off."""

    def __init__(self, model: Model):
        codecs.register_error("corpusmill_each_byte", _each_byte)
        self.surfaces = []
        for piece, kind in zip(model.pieces, model.kinds, strict=True):
            if kind == "byte":
                self.surfaces.append(bytes([int(piece[3:-1], 16)]))
            else:
                shown = {"control": "", "unknown": UNKNOWN_SURFACE}.get(kind, piece.replace(SPACE, " "))
                self.surfaces.append(shown.encode())
        self.fronts = {i for i, p in enumerate(model.pieces) if model.kinds[i] == "normal" and p.startswith(SPACE)}
        self.silent = {i for i, kind in enumerate(model.kinds) if kind == "control"}

    def __call__(self, ids: list[int]) -> str:
        surfaces = self.surfaces
        text = b"".join(map(surfaces.__getitem__, ids)).decode("utf-8", "corpusmill_each_byte")
        first = next((i for i in ids if i not in self.silent), None)
        return text[1:] if first in self.fronts else text


def _encode(model, text_column: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = Encoder(Model(*model.value)).raw
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                found = [raw(x or "") for x in batch.column(text_column).to_pylist()]
                ends = np.cumsum([0] + [len(x) // 4 for x in found]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), dtype=np.int32)))
                yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, "ids"])

    return work


def _decode(model, ids: str, name: str) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = Decoder(Model(*model.value))
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                column = batch.column(ids)
                flat, ends = column.flatten().to_numpy(), np.cumsum([0, *column.value_lengths().fill_null(0).to_pylist()])
                texts = [decode(flat[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, name])

    return work


def encode(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The columns of ``docs`` and ids. A null or empty text has no ids; repeated rows get the same ids."""
    docs = docs.drop("ids") if text != "ids" else docs
    sent = docs.sparkSession.sparkContext.broadcast(model.plain())
    schema = T.StructType([*docs.schema.fields, IDS])
    return docs.mapInArrow(_encode(sent, docs.columns.index(text)), schema)


def decode(rows: DataFrame, model: Model, ids: str = "ids") -> DataFrame:
    """The columns of ``rows`` and decoded; null or no ids give an empty text."""
    rows = rows.drop("decoded")
    sent = rows.sparkSession.sparkContext.broadcast(model.plain())
    return rows.mapInArrow(_decode(sent, ids, "decoded"), T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())]))


def round_trip(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The other columns of ``docs`` and ids, decoded: both steps in one task, so that the ids cross to it once."""
    docs = docs.drop(*[c for c in ("ids", "decoded") if c != text])
    sent = docs.sparkSession.sparkContext.broadcast(model.plain())
    there, back = _encode(sent, docs.columns.index(text)), _decode(sent, "ids", "decoded")
    others = [f for f in docs.schema.fields if f.name != text]
    names = [f.name for f in others]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in back(there(batches)):
            yield batch.select([*names, "ids", "decoded"])

    return docs.mapInArrow(work, T.StructType([*others, IDS, T.StructField("decoded", T.StringType())]))
