"""Packing of documents into fixed windows: bounded-space online best fit.

Method.  Each partition keeps a fixed number of open windows.  A document is cut
into full windows and a rest; the rest goes where it fits best.  If it fits
nowhere, the fullest window is emitted (a gap worth a cut is filled with the
head of the piece first) and a new one is opened.  Windows still open at the end
of a partition are the leftovers; they are merged in rounds, many partitions to
one, until one task has the last few and packs them without gaps.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.storage import Scratch
from cohortlens.llm.tokens import word_ids

WINDOW = 2048
OPEN = 64
MIN_CUT = 24
FAN_IN = 16
END_ID = 1

_PIECE = "doc long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, home long, ids binary"


class _Packer:
    """Open windows of one task. A piece is (doc, start, ids as bytes, tokens of its document)."""

    def __init__(self, window: int, most: int, min_cut: int, first_id: int):
        self.window, self.most, self.min_cut = window, most, min_cut
        self.open: list[list] = []  # [free, pieces]
        self.next_id = first_id
        self.done: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            self.done.append((doc, start, ids, total, self.next_id, at))
            at += len(ids) // 4
        self.next_id += 1

    def _full(self, w: list) -> None:
        self.open.remove(w)
        self._close(w[1])

    def add(self, doc: int | None, start: int, ids: bytes, total: int) -> None:
        while True:
            length = len(ids) // 4
            if length >= self.window:
                self._close([(doc, start, ids[: 4 * self.window], total)])
                start, ids = start + self.window, ids[4 * self.window :]
                if ids:
                    continue
                return
            best = min((w for w in self.open if w[0] >= length), key=lambda w: w[0], default=None)
            if best is None and len(self.open) < self.most:
                best = [self.window, []]
                self.open.append(best)
            if best is not None:
                best[0] -= length
                best[1].append((doc, start, ids, total))
                if best[0] == 0:
                    self._full(best)
                return
            fullest = min(self.open, key=lambda w: w[0])
            gap = fullest[0]
            if gap >= self.min_cut and length - gap >= self.min_cut:
                fullest[1].append((doc, start, ids[: 4 * gap], total))
                start, ids = start + gap, ids[4 * gap :]
            self._full(fullest)

    def last(self) -> None:
        """Pack what is open one after another, cut wherever a window ends."""
        held, room = [], self.window
        for _, pieces in self.open:
            for doc, start, ids, total in pieces:
                while ids:
                    head = ids[: 4 * room]
                    held.append((doc, start, head, total))
                    start, ids, room = start + len(head) // 4, ids[len(head) :], room - len(head) // 4
                    if room == 0:
                        self._close(held)
                        held, room = [], self.window
        if held:
            self._close(held)
        self.open = []

    def taken(self, with_ids: bool) -> pa.RecordBatch:
        rows, self.done = self.done, []
        return _batch([(*r, None) for r in rows], with_ids)

    def leftovers(self, home: int) -> pa.RecordBatch:
        return _batch([(*p, None, None, home) for _, pieces in self.open for p in pieces], True)


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    doc, start, ids, total, sequence, at, home = zip(*rows, strict=True) if rows else ((),) * 7
    long = pa.int64()
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc, long), pa.array(start, long), pa.array([len(x) // 4 for x in ids], long),
            pa.array([zlib.crc32(x) for x in ids], long), pa.array(total, long), pa.array(sequence, long),
            pa.array(at, long), pa.array(home, long), pa.array(ids if with_ids else [None] * len(ids), pa.binary()),
        ],
        names=["doc", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "home", "ids"],
    )


def _first_pass(path: str, end_id: int, window: int, most: int, min_cut: int, with_ids: bool):
    end = end_id.to_bytes(4, "little")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home = TaskContext.get().partitionId()
        packer = _Packer(window, most, min_cut, home << 24)
        words = word_ids(path)
        for b in parts:
            for i in range(0, b.num_rows, 256):
                some = b.slice(i, 256)
                for doc, ids in zip(
                    some.column("doc").to_pylist(), words.encode(some.column("text").to_pylist()), strict=True
                ):
                    packer.add(doc, 0, ids + end, len(ids) // 4 + 1)
                yield packer.taken(with_ids)
        yield packer.leftovers(home)

    return run


def _merge(round_no: int, window: int, most: int, min_cut: int, with_ids: bool, last: bool):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        packer = _Packer(window, most, min_cut, (round_no << 56) + (key[0].as_py() << 24))
        rows = group.select(["length", "doc", "start", "ids", "doc_tokens"]).to_pylist()
        for r in sorted(rows, key=lambda r: -r["length"]):
            packer.add(r["doc"], r["start"], r["ids"], r["doc_tokens"])
        if last:
            packer.last()
        return pa.Table.from_batches([packer.taken(with_ids), packer.leftovers(key[0].as_py())])

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    key: str = "doc_id",
    text: str = "text",
    *,
    window: int = WINDOW,
    open_windows: int = OPEN,
    min_cut: int = MIN_CUT,
    end_id: int = END_ID,
    fan_in: int = FAN_IN,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``key, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``).

    A document's ids are those of the tokenizer for its text, then ``end_id``;
    a null text counts as empty and gives ``end_id`` alone.  Each id is in
    exactly one piece.  ``start`` counts the ids of the document before the
    piece, ``offset`` those of the sequence before it, without gaps;
    ``doc_tokens`` are all ids of the document.  A sequence holds at most
    ``window`` ids.  ``ids`` (``with_ids``) are little-endian unsigned 32-bit.

    Rows are packed as they are: a repeated row is packed twice, a null key
    gives null.  Keys are integers.  Columns not named are not read.

    Memory: a task holds ``open_windows`` windows, and in a merge those of
    ``fan_in`` tasks; pieces go out as soon as their window closes.  A gap of
    ``min_cut`` ids or more is filled by a cut, so that bounds the padding of
    every sequence but the last one.
    """
    if not 0 < window < 1 << 24:
        raise ValueError("window out of range")
    scratch = Scratch(docs.sparkSession, "packing")
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    first = scratch.table(
        rows.mapInArrow(_first_pass(tokenizer_path, end_id, window, open_windows, min_cut, with_ids), _PIECE), "pieces"
    )
    closed, left, round_no = first.where("home is null"), first.where("home is not null"), 1
    while True:
        homes = left.agg(F.max("home")).first()[0]
        if homes is None:
            break
        last = homes < fan_in
        merged = left.groupBy(F.floor(F.col("home") / fan_in).cast("long").alias("to")).applyInArrow(
            _merge(round_no, window, open_windows, min_cut, with_ids, last), _PIECE
        )
        merged = scratch.table(merged, "merged")
        closed = closed.unionByName(merged.where("home is null"))
        left, round_no = merged.where("home is not null"), round_no + 1
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    return closed.select(F.col("doc").alias(key), *names)
