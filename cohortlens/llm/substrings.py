"""Exact removal of repeated passages, by recompression of word sequences.

Method.  Rounds give every text a shorter and shorter sequence of symbols:
first each run of one word becomes a symbol, then rounds of pairs replace
``ab`` wherever ``a`` is on the left side of that round and ``b`` on the right.
A symbol's name is a hash of what it stands for and its side a hash of its name,
so all texts of all tasks agree on names without an exchange, and equal passages
carry equal symbols but for some at their ends.  For each window the rounds go
on while some symbol is still settled by the window's own words; one of the
last settled symbols is the window's anchor.  Equal windows have equal anchors.

1. Texts are put into blocks of a few megabytes, compressed, written once.
2. Each block sends the names of its anchors, each once; names met twice
   anywhere come back to the blocks that have them.
3. Windows on such names are verified: a block sends an 80-bit hash of each
   distinct one with its place to a part named by another hash; all but the
   globally first come back.
4. Blocks drop the words of these windows.

A block settles its own repeats first and sends one record for each name or
window, so a passage of a third of all documents is a record per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.storage import Scratch
from cohortlens.llm.words import scramble, word_hashes, words_of

WINDOW = 20
BLOCK_BYTES = 4 << 20
#: words of the corpus for each part of the two exchanges
PART_WORDS = 2_000_000

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def _pair(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    return scramble(a * _A + scramble(b + np.uint64(salt)))


def anchors(hashes: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Name and first word of the anchor of each window of ``width`` words.

    ``doc`` numbers the document of each word; windows that would leave their
    document must be masked by the caller, their anchors mean nothing.
    """
    n = len(hashes) - width + 1
    name, place = np.zeros(n, np.uint64), np.zeros(n, np.int64)

    def choose(which: np.ndarray, lo: np.ndarray, hi: np.ndarray, names: np.ndarray, starts: np.ndarray) -> None:
        best = lo.copy()
        for k in range(1, 4):
            other = np.minimum(lo + k, len(names) - 1)
            best = np.where((lo + k < hi) & (names[other] < names[best]), other, best)
        name[which], place[which] = names[best], starts[best]

    # runs of one word
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, len(hashes)))
    names = _pair(hashes[starts], lengths.astype(np.uint64), 1)
    run_of = np.cumsum(first) - 1
    at = np.arange(n)
    lo, hi = run_of[at] + 1, run_of[at + width - 1]  # the runs at both ends may go on outside
    alone = lo >= hi
    if alone.any():  # no settled symbol: the window is its own anchor
        whole = window_hashes(hashes, width, 2)
        name[alone], place[alone] = whole[alone], at[alone]
    at, lo, hi = at[~alone], lo[~alone], hi[~alone]

    level = 2
    while len(at):
        choose(at, lo, hi, names, starts)  # stands unless the next level has a settled symbol too
        right = (scramble(names + np.uint64(level)) & np.uint64(1)).astype(bool)
        lo = lo + right[lo]
        hi = hi - ~right[hi - 1]
        same = doc[starts[1:]] == doc[starts[:-1]]
        joins = np.append(~right[:-1] & right[1:] & same, False)
        head = np.append(True, ~joins[:-1])
        of = np.cumsum(head) - 1
        at, lo, hi = (x[lo < hi] for x in (at, lo, hi))
        if not len(at):
            break
        lo, hi = of[lo], of[hi - 1] + 1
        kept = np.flatnonzero(head)
        paired = joins[kept]
        merged = names[kept].copy()
        merged[paired] = _pair(names[kept][paired], names[kept[paired] + 1], level)
        names, starts = merged, starts[kept]
        level += 1
    return name, place


def window_hashes(hashes: np.ndarray, width: int, salt: int) -> np.ndarray:
    """Hash of each window of ``width`` words, put together from powers of two."""
    n = len(hashes) - width + 1
    out, done, part, size = np.zeros(n, np.uint64), 0, hashes, 1
    while True:
        if width & size:
            out = _pair(out, part[done : done + n], salt)
            done += size
        if done == width:
            return out
        part = _pair(part[:-size], part[size:], salt)
        size *= 2


def _pack(array: np.ndarray) -> bytes:
    return zstandard.compress(array.tobytes(), 1)


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def _to_blocks(block_bytes: int):
    """Rows of a partition as blocks: record batches in Arrow's stream format, compressed."""

    def written(rows: list[pa.RecordBatch]) -> bytes:
        sink = pa.BufferOutputStream()
        whole = pa.Table.from_batches(rows).combine_chunks()
        with pa.ipc.new_stream(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as out:
            out.write_table(whole)
        return sink.getvalue().to_pybytes()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def block() -> pa.RecordBatch:
            words = sum(len(words_of(t)) for b in held for t in b.column("text").to_pylist())
            return pa.RecordBatch.from_arrays(
                [pa.array([base + made], pa.int64()), pa.array([words], pa.int64()), pa.array([written(held)], pa.binary())],
                names=["block", "words", "payload"],
            )

        for b in parts:
            sizes = pc.binary_length(b.column("text")).fill_null(0).to_numpy(zero_copy_only=False)
            begin = 0
            for i in range(b.num_rows):
                size += int(sizes[i]) + 64
                if size >= block_bytes:
                    held.append(b.slice(begin, i + 1 - begin))
                    yield block()
                    made, held, size, begin = made + 1, [], 0, i + 1
            if begin < b.num_rows:
                held.append(b.slice(begin))
        if held:
            yield block()

    return run


class _Block:
    """The documents of a block in key order, with their words one after another."""

    def __init__(self, payload: bytes, width: int):
        rows = pa.ipc.open_stream(payload).read_all()
        self.rows = rows.sort_by([("key", "ascending")])  # nulls last
        self.keys = self.rows["key"].fill_null(np.iinfo(np.int64).max).to_numpy()
        self.words = [words_of(t) for t in self.rows["text"].to_pylist()]
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)])
        self.width = width

    def hashed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash and document of each word; which windows stay in their document."""
        flat = [w for ws in self.words for w in ws]
        hashes = word_hashes(flat)
        doc = np.repeat(np.arange(len(self.words)), self.lengths)
        n = max(0, len(hashes) - self.width + 1)
        return hashes, doc, doc[:n] == doc[self.width - 1 :] if n else np.zeros(0, bool)


def _rows(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in parts:
        for i in range(b.num_rows):
            yield {name: b.column(name)[i].as_py() for name in b.schema.names}


def _sent(part: list[int], block: int, data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int64()), pa.array([block] * len(part), pa.int64()), pa.array(data, pa.binary())],
        names=["part", "block", "data"],
    )


def _send_names(width: int, n_parts: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(parts):
            hashes, doc, inside = _Block(r["payload"], width).hashed()
            if not inside.any():
                continue
            name, place = anchors(hashes, doc, width)
            name, place = name[inside], place[inside]
            order = np.lexsort((place, name))
            name, place = name[order], place[order]
            new = np.append(True, (name[1:] != name[:-1]) | (place[1:] != place[:-1]))
            found, times = np.unique(name[new], return_counts=True)
            of = (found % np.uint64(n_parts)).astype(np.int64)
            order = np.argsort(of, kind="stable")
            cut = np.flatnonzero(np.append(True, of[order][1:] != of[order][:-1]))
            found = (found >> np.uint64(32)).astype(np.uint32)  # the part has told some bits already
            data = [
                b"".join((len(x).to_bytes(4, "little"), found[x].tobytes(), (times[x] > 1).tobytes()))
                for x in np.split(order, cut[1:])
            ]
            yield _sent(of[order][cut].tolist(), r["block"], data)

    return run


def _met_twice(group: pa.Table) -> pa.Table:
    blocks, names, many = [], [], []
    for d in group["data"].to_pylist():
        n = int.from_bytes(d[:4], "little")
        names.append(np.frombuffer(d, np.uint32, n, 4))
        many.append(np.frombuffer(d, bool, n, 4 + 4 * n))
    flat = np.concatenate(names)
    found, of, times = np.unique(flat, return_inverse=True, return_counts=True)
    often = times > 1
    often[of[np.concatenate(many)]] = True
    hit, begin, data = often[of], 0, []
    part = group["part"][0].as_py().to_bytes(8, "little")
    for block, x in zip(group["block"].to_pylist(), names, strict=True):
        mine = x[hit[begin : begin + len(x)]]
        begin += len(x)
        if len(mine):
            blocks.append(block)
            data.append(part + mine.tobytes())
    return pa.table({"block": pa.array(blocks, pa.int64()), "data": pa.array(data, pa.binary())})


def _told(data: bytes) -> np.ndarray:
    return np.uint64(int.from_bytes(data[:8], "little") << 32) | np.frombuffer(data, np.uint32, -1, 8).astype(np.uint64)


def _send_windows(width: int, n_parts: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(parts):
            block = _Block(r["payload"], width)
            hashes, doc, inside = block.hashed()
            name, _ = anchors(hashes, doc, width)
            often = np.sort(np.concatenate([_told(d) for d in r["names"]]))
            asked = (name % np.uint64(n_parts) << np.uint64(32)) | (name >> np.uint64(32))
            spot = np.minimum(np.searchsorted(often, asked), len(often) - 1)
            at = np.flatnonzero(inside & (often[spot] == asked))
            h1 = window_hashes(hashes, width, 3)[at]
            h2 = (window_hashes(hashes, width, 4)[at] >> np.uint64(48)).astype(np.uint16)
            order = np.lexsort((h2, h1))  # stable: the first of equals is the earliest
            again = np.append(False, (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1]))
            local = np.sort(at[order[again]])
            if len(local):
                yield _sent([-1 - r["block"] % n_parts], r["block"], [_pack(local.astype(np.int32))])
            first = np.sort(order[~again])
            h1, h2, at = h1[first], h2[first], at[first]
            of = (window_hashes(hashes, width, 5)[at] % np.uint64(n_parts)).astype(np.int64)
            order = np.argsort(of, kind="stable")
            cut = np.flatnonzero(np.append(True, of[order][1:] != of[order][:-1]))
            data = []
            for x in np.split(order, cut[1:]):
                key = block.keys[doc[at[x]]]
                steps = np.diff(key, prepend=np.int64(0))
                data.append(
                    len(x).to_bytes(4, "little") + h1[x].tobytes() + h2[x].tobytes()
                    + _pack(np.concatenate([steps, np.diff(at[x], prepend=0)]))
                )
            yield _sent(of[order][cut].tolist(), r["block"], data)

    return run


def _not_first(group: pa.Table) -> pa.Table:
    if group["part"][0].as_py() < 0:  # a block's own repeats
        return group.select(["block", "data"])
    sent = group["block"].to_pylist()
    h1, h2, key, at, of = [], [], [], [], []
    for i, d in enumerate(group["data"].to_pylist()):
        n = int.from_bytes(d[:4], "little")
        h1.append(np.frombuffer(d, np.uint64, n, 4))
        h2.append(np.frombuffer(d, np.uint16, n, 4 + 8 * n))
        steps = _unpack(d[4 + 10 * n :], "<i8")
        key.append(np.cumsum(steps[:n]))
        at.append(np.cumsum(steps[n:]))
        of.append(np.full(n, i))
    h1, h2, key, at, of = map(np.concatenate, (h1, h2, key, at, of))
    order = np.lexsort((at, np.array(sent)[of], key, h2, h1))
    again = np.append(False, (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1]))
    late = order[again]
    blocks, data = [], []
    late = late[np.lexsort((at[late], of[late]))]
    for x in np.split(late, np.flatnonzero(np.diff(of[late])) + 1):
        if len(x):
            blocks.append(sent[of[x[0]]])
            data.append(_pack(at[x].astype(np.int32)))
    return pa.table({"block": pa.array(blocks, pa.int64()), "data": pa.array(data, pa.binary())})


def _cut(width: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(parts):
            block = _Block(r["payload"], width)
            cover = np.zeros(block.begins[-1] + 1, np.int64)
            for d in r["late"] or []:
                at = _unpack(d, "<i4")
                np.add.at(cover, at, 1)
                np.add.at(cover, at + width, -1)
            gone = np.cumsum(cover)[:-1] > 0
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[block.begins])
            texts = []
            for i, ws in enumerate(block.words):
                if removed[i]:
                    mask = gone[block.begins[i] : block.begins[i + 1]]
                    ws = [w for w, g in zip(ws, mask, strict=True) if not g]
                texts.append(b" ".join(ws).decode("utf-8", "surrogatepass"))
            out = block.rows.append_column("n_words", pa.array(block.lengths))
            out = out.append_column("n_removed", pa.array(removed, pa.int64()))
            out = out.append_column("kept_text", pa.array(texts, pa.string()))
            yield from out.combine_chunks().to_batches(max_chunksize=1024)

    return run


def drop_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    *,
    carry: tuple[str, ...] = (),
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per input row: ``key``, the columns of ``carry``, ``n_words, n_removed, kept_text``.

    Words are cut at ASCII blanks and compared as they are.  A word goes when a
    window of ``window`` consecutive words that covers it also starts earlier:
    in a row with a smaller key, or earlier in the same row.  ``kept_text`` has
    the kept words, joined by one space.

    A null or empty text has no words and gives the empty text.  Texts shorter
    than a window are never cut.  Keys are integers; of rows with equal keys one
    counts as earlier, so of repeated rows one stays whole; rows with a null key
    come after all others.  Columns not named are not read; a carried column may
    not be called like one of the result.

    Memory: a task holds one block (one text, where that is longer) and, in the
    two exchanges, one part; the number of parts follows the number of words.
    """
    if {*carry} & {key, text, "n_words", "n_removed", "kept_text"}:
        raise ValueError("a carried column has the name of a result column")
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    renamed = {c: f"carried_{i}" for i, c in enumerate(carry)}
    rows = docs.select(
        F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"),
        *(F.col(c).alias(new) for c, new in renamed.items()),
    )
    blocks = scratch.table(rows.mapInArrow(_to_blocks(block_bytes), "block long, words long, payload binary"), "blocks")
    total = blocks.agg(F.sum("words")).first()[0] or 0
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_WORDS))
    packed = "part long, block long, data binary"

    names = blocks.select("block", "payload").mapInArrow(_send_names(window, n_parts), packed)
    twice = names.groupBy("part").applyInArrow(_met_twice, "block long, data binary")
    asked = twice.groupBy("block").agg(F.collect_list("data").alias("names"))
    windows = (
        blocks.select("block", "payload").join(asked, "block").mapInArrow(_send_windows(window, n_parts), packed)
    )
    late = scratch.table(windows.groupBy("part").applyInArrow(_not_first, "block long, data binary"), "late")
    late = late.groupBy("block").agg(F.collect_list("data").alias("late"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    out = blocks.select("block", "payload").join(late, "block", "left").mapInArrow(
        _cut(window), f"{fields}, n_words long, n_removed long, kept_text string"
    )
    return out.select(
        F.col("key").alias(key), *(F.col(new).alias(c) for c, new in renamed.items()), "n_words", "n_removed", "kept_text"
    )
