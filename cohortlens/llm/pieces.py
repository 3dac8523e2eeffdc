"""SentencePiece models of the merge type: exact encoding by backtracking, and decoding.

Method.  A sequence of pieces is the encoding of a text exactly when each pair
of neighbours is the encoding of the two together, since merges that stay
inside pieces do not depend on what is around them.  So pieces are tried from
the left, longest match first (an Aho-Corasick automaton finds the longest
piece at every position in one pass).  A piece is taken when it fits the one
before it, which is looked up or decided by merging the two again.  If no piece
fits, the one before is taken back and a shorter one tried; positions that led
nowhere are marked, so none is tried twice and the work is linear.

A text is cut first wherever no piece has the two neighbours next to each other
(before a blank, around a digit, between a letter and a mark), and each distinct
part of some texts is encoded once.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.tokens import REMEMBERED, TOGETHER, gathered, placed

#: stands for a blank in pieces
BLANK = "▁"
#: pairs of neighbours that a worker remembers
PAIRS = 1_000_000
#: rows of a batch that are encoded or decoded together
SLICE = 256
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6

_of_worker: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """The codec of this worker process for a model file; parts it has met stay known over tasks."""
    if path not in _of_worker:
        _of_worker[path] = PieceCodec(path)
    return _of_worker[path]


class PieceCodec:
    """Encodes and decodes as the model file says.

    It must be of the merge type, take texts as they are but for a blank put
    first, and write unknown characters as bytes.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules, made = model.normalizer_spec, model.trainer_spec
        plain = rules.add_dummy_prefix and rules.escape_whitespaces and not (
            rules.remove_extra_whitespaces or rules.precompiled_charsmap or made.treat_whitespace_as_suffix
        )
        if made.model_type != made.BPE or not made.byte_fallback or not plain:
            raise ValueError("not a merge model with a leading blank, texts as they are, and byte fallback")
        kinds = [p.type for p in model.pieces]
        if not set(kinds) <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("pieces defined by users are not supported")
        self.end_id = next(i for i, p in enumerate(model.pieces) if p.piece == made.eos_piece)
        self._remembered = remembered
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._pairs: dict[int, bool] = {}

        self._text = [p.piece for p in model.pieces]
        self._score = {p.piece: p.score for p, k in zip(model.pieces, kinds, strict=True) if k == _NORMAL}
        self._id = {p: i for i, (p, k) in enumerate(zip(self._text, kinds, strict=True)) if k == _NORMAL}
        if any(c not in self._id for p in self._id for c in p):
            raise ValueError("a piece has a character that is no piece")
        # whether a text may be cut between two bytes: not within a character, nor where a piece has these two
        self._cut = np.ones((256, 256), bool)
        self._cut[:, 0x80:0xC0] = False
        for p in self._id:
            data = np.frombuffer(p.replace(BLANK, " ").encode(), np.uint8)
            self._cut[data[:-1], data[1:]] = False
        self._length = [len(p) for p in self._text]
        self._shorter = [-1] * len(kinds)  # the longest piece that a piece begins with
        self._automaton = ahocorasick.Automaton()
        for p, i in self._id.items():
            self._automaton.add_word(p, i)
            self._shorter[i] = next((self._id[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self._id), -1)
        self._automaton.make_automaton()

        bytes_of = {i: int(self._text[i][3:5], 16) for i, k in enumerate(kinds) if k == _BYTE}
        self._byte = np.zeros(256, "<u4")
        self._byte[list(bytes_of.values())] = list(bytes_of)
        surface = [
            bytes([bytes_of[i]]) if k == _BYTE else b"" if k == _CONTROL
            else (made.unk_surface if k == _UNKNOWN else self._text[i].replace(BLANK, " ")).encode()
            for i, k in enumerate(kinds)
        ]
        self._surface = np.frombuffer(b"".join(surface), np.uint8)
        self._size = np.array([len(s) for s in surface], np.int64)
        self._begin = np.cumsum(self._size) - self._size
        self._silent = np.array(kinds) == _CONTROL
        self._leads = np.array([k == _NORMAL and t.startswith(BLANK) for k, t in zip(kinds, self._text, strict=True)])

    def _merged(self, text: str) -> list[str]:
        """A short text merged by the rule itself: the best score first, then the leftmost."""
        parts, score = list(text), self._score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _fits(self, left: int, right: int) -> bool:
        """Whether two pieces next to each other stay so; -1 on the left is the begin."""
        if len(self._pairs) >= PAIRS:
            self._pairs.clear()
        own = [self._text[right]] if left < 0 else [self._text[left], self._text[right]]
        known = self._pairs[left << 32 | right] = self._merged("".join(own)) == own
        return known

    def _backtrack(self, longest: Sequence[int], low: int, high: int) -> list[int]:
        """Pieces of the characters from ``low`` to ``high``, all of which are pieces themselves."""
        length, shorter, known = self._length, self._shorter, self._pairs.get
        failed = bytearray(high - low + 1)
        taken: list[int] = []
        left, at, piece = -1, low, longest[low]
        while True:
            while piece >= 0:
                end = at + length[piece]
                if not failed[end - low]:
                    fits = known(left << 32 | piece)
                    if self._fits(left, piece) if fits is None else fits:
                        break
                piece = shorter[piece]
            if piece >= 0:
                taken.append(piece)
                if end == high:
                    return taken
                left, at, piece = piece, end, longest[end]
            else:
                failed[at - low] = 1
                piece = taken.pop()
                left = taken[-1] if taken else -1
                at -= length[piece]

    def _part(self, part: str) -> bytes:
        text = part.replace(" ", BLANK)
        longest = array("i", [-1]) * len(text) if len(text) > 1 << 16 else [-1] * len(text)
        length = self._length
        for end, piece in self._automaton.iter(text):  # a later end overwrites an earlier one
            longest[end + 1 - length[piece]] = piece
        if -1 not in longest:
            return np.array(self._backtrack(longest, 0, len(text)), "<u4").tobytes()
        out: list[int] = []
        low = 0
        while low < len(text):
            high = low
            while high < len(text) and longest[high] >= 0:
                high += 1
            if high > low:
                out += self._backtrack(longest, low, high)
            while high < len(text) and longest[high] < 0:
                out += self._byte[list(text[high].encode())].tolist()
                high += 1
            low = high
        return np.array(out, "<u4").tobytes()

    def _of_parts(self, parts: list[str]) -> list[bytes]:
        if len(self._new) > self._remembered:
            self._old, self._new = self._new, {}
        new, old, out = self._new, self._old, []
        for p in parts:
            ids = new.get(p)
            if ids is None:
                ids = old.get(p)
                ids = new[p] = self._part(p) if ids is None else ids
            out.append(ids)
        return out

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers, without an end id."""
        out: list[bytes] = []
        held, size = [], 0
        for t in texts:
            # a literal blank sign is what a blank becomes
            held.append((" " + t.replace(BLANK, " ")).encode("utf-8", "replace") if t else b"")
            size += len(held[-1])
            if size > TOGETHER:
                out += self._encode(held)
                held, size = [], 0
        return out + self._encode(held)

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        offsets = np.cumsum([0, *map(len, texts)])
        data = np.frombuffer(b"".join(texts), np.uint8)
        begins = np.ones(len(data), bool)
        begins[1:] = self._cut[data[:-1], data[1:]]
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        at = np.concatenate([np.flatnonzero(begins), [len(data)]])
        parts = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data))
        known = parts.dictionary_encode()
        ids, at = gathered(
            self._of_parts(known.dictionary.to_pylist()), known.indices.to_numpy(), np.searchsorted(at, offsets)
        )
        at = (4 * at).tolist()
        return [ids[i:j] for i, j in zip(at, at[1:], strict=False)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The text of each row of ids, which begin at ``offsets``; ids beyond the vocabulary are an error."""
        begin, size = self._begin[ids], self._size[ids]
        sounding = np.flatnonzero(~self._silent[ids])
        first = np.searchsorted(sounding, offsets[:-1])
        first = sounding[first[first < len(sounding)]]  # of a row without any: one of a later row, once more
        first = np.unique(first[self._leads[ids[first]]])
        begin[first] += 1
        size[first] -= 1
        data = placed(self._surface, begin, size)
        at = np.concatenate([[0], np.cumsum(size)])[offsets].tolist()
        return [_text(data[i:j]) for i, j in zip(at, at[1:], strict=False)]


def _text(data: bytes) -> str:
    """A replacement character stands for every byte that is not part of a character."""
    out = []
    while True:
        try:
            return "".join([*out, data.decode()])
        except UnicodeDecodeError as e:
            out += [data[: e.start].decode(), "�"]
            data = data[e.start + 1 :]


def _slices(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in rows:
        for i in range(0, b.num_rows, SLICE):
            yield b.slice(i, SLICE)


def _with(b: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(b.column(c) for c in range(b.num_columns - 1)), column], [*b.schema.names[:-1], name])


def encode_pieces(
    docs: DataFrame, model_path: str, keep: Sequence[str] = ("doc_id",), text: str = "text", *, with_end: bool = True
) -> DataFrame:
    """One row per row: the ``keep`` columns and ``ids array<int>``, those of the whole text.

    A null or an empty text has no ids but the end id, which comes last
    ``with_end``.  Rows are encoded each for itself, so repeated rows and null
    keys stay as they are.  Columns not named are not read.  The model file
    must be at ``model_path`` on every executor.

    Memory: a task holds a batch and the parts it met last.  A part without
    blanks takes four bytes a character beside its text; work is linear.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path)
        end = own.end_id.to_bytes(4, "little") if with_end else b""
        for b in _slices(rows):
            ids = [x + end for x in own.encode(b.column(b.num_columns - 1).to_pylist())]
            at = np.cumsum([0, *(len(x) // 4 for x in ids)])
            values = np.frombuffer(b"".join(ids), "<i4")
            yield _with(b, "ids", pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values)))

    rows = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(run, _schema(rows, "ids", "array<int>"))


def decode_pieces(rows: DataFrame, model_path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """The rows with ``ids`` replaced by the text they stand for, last and under ``name``.

    Control ids are silent, bytes are put together to characters, a leading
    blank piece loses its first blank.  Null ids have a null text.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path)
        for b in _slices(parts):
            given = b.column(b.num_columns - 1)
            at = np.concatenate([[0], np.cumsum(np.array([0 if x is None else x for x in pa.compute.list_value_length(given).to_pylist()]))])
            texts = own.decode(given.flatten().to_numpy(), at)
            known = given.is_valid().to_pylist()
            yield _with(b, name, pa.array([t if k else None for t, k in zip(texts, known, strict=True)], pa.string()))

    rest = rows.select(*(c for c in rows.columns if c != ids), F.col(ids).cast("array<int>").alias("_ids"))
    return rest.mapInArrow(run, _schema(rest, name, "string"))


def _schema(rows: DataFrame, name: str, kind: str) -> str:
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return ", ".join([*fields, f"`{name}` {kind}"])
