"""Token ids of texts, word by word.

The tokenizers used here drop white space and never look across it, so a text's
ids are those of its words one after another.  The words of some texts are made
a dictionary, each distinct word is looked up or encoded once, and the ids of
the texts are gathered from it as arrays.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: words kept per generation and worker; two generations are held (about 150 MB)
REMEMBERED = 350_000
#: bytes of texts whose words are looked up together
TOGETHER = 1 << 22

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK, _PLAIN, _MARK = 1, 2, 4
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t\n\x0b\x0c\r")] = _BLANK
_KIND[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = _PLAIN
_KIND[list(b"!#$%&()*+,-./:;=?@[]^_{|}~\"'")] = _MARK
#: a capital with a combining mark: some such pairs make one character in lower case only
_MARKED_CAPITAL = re.compile(rb"[A-Z][\xcc\xcd]")


def _plain_words(texts: list[bytes]) -> pa.Array:
    """Texts in lower case (A-Z only), with a blank before the ASCII marks that end a word.

    A blank is put in only where an ASCII letter or digit stands before the
    marks and a blank or the end after them.  Texts that may hold a special
    token or a capital with a combining mark stay as they are.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.concatenate([[0], np.cumsum(sizes + 1)])  # each text ends with a line feed here
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    low = _LOWER[data]
    kind = _KIND[low]
    for k, t in enumerate(texts):
        if b"<|" in t or _MARKED_CAPITAL.search(t):
            low[offsets[k] : offsets[k + 1]] = data[offsets[k] : offsets[k + 1]]
            kind[offsets[k] : offsets[k + 1]] = 0
    mark = kind == _MARK
    turns = np.flatnonzero(mark[1:] != mark[:-1]) + 1  # a run of marks begins, ends, begins ...
    turns = turns[1:] if len(mark) and mark[0] else turns
    begins, ends = turns[0::2], turns[1::2]
    cuts = begins[(kind[begins - 1] == _PLAIN) & (kind[ends] == _BLANK)]
    offsets += np.searchsorted(cuts, offsets)
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(np.insert(low, cuts, 32)))


#: items whose places are worked out together
_BLOCK = 1 << 18


def placed(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> bytes:
    """The stretches of ``flat`` that begin at ``begins`` and have ``sizes`` items, one after another."""
    out = []
    for i in range(0, len(begins), _BLOCK):
        size = sizes[i : i + _BLOCK]
        ends = np.cumsum(size)
        shift = begins[i : i + _BLOCK] - ends + size
        out.append(flat[np.repeat(shift, size) + np.arange(ends[-1])].tobytes())
    return b"".join(out)


def gathered(parts: Sequence[bytes], index: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray]:
    """``parts[index]`` joined, and where the groups that begin at ``offsets`` of ``index`` begin in it.

    Parts hold 32-bit numbers, which places count.
    """
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    own = sizes[index]
    at = np.concatenate([[0], np.cumsum(own)])[offsets]
    return placed(np.frombuffer(b"".join(parts), "<u4"), (np.cumsum(sizes) - sizes)[index], own), at


_of_worker: dict[tuple[str, int], WordIds] = {}


def word_ids(path: str, remembered: int | None = None) -> WordIds:
    """The encoder of this worker process for a tokenizer file; words it has met stay known over tasks."""
    which = (path, remembered or REMEMBERED)
    if which not in _of_worker:
        _of_worker[which] = WordIds(*which)
    return _of_worker[which]


class WordIds:
    """Ids as little-endian unsigned 32-bit numbers, for a tokenizer that treats words alone.

    It must lower-case, split runs of letters or digits from punctuation, and
    mark the last token of a run with ``</w>``.  Texts are lower-cased first
    (A-Z only) and ASCII marks at the end of a word are cut off where an ASCII
    letter or digit stands before them, so fewer words are distinct; texts that
    may hold a special token or a capital with a combining mark are left as
    they are.  Runs of letters are encoded in one go and told apart by their
    last tokens.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._remembered = remembered
        self._new: dict[str, bytes] = {"": b""}
        self._old: dict[str, bytes] = {}
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def _each(self, words: list[str]) -> list[bytes]:
        encoded = self._tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words that are one run of letters each."""
        ids = self._tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids
        ids = np.array(ids, "<u4")
        cuts = np.flatnonzero(self._ends[ids]) + 1
        if len(cuts) != len(words) or (len(ids) and cuts[-1] != len(ids)):
            return self._each(words)
        data, at = ids.tobytes(), (4 * cuts).tolist()
        return [data[i:j] for i, j in zip([0, *at], at, strict=False)]

    def _of_words(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        if len(self._new) > self._remembered:
            self._old, self._new = self._new, {"": b""}
        new, old = self._new, self._old
        letters, others = [], []
        for w in words:
            if w not in new:
                ids = old.get(w)
                if ids is not None:
                    new[w] = ids
                else:
                    (letters if w.isalpha() else others).append(w)
        if letters:
            new.update(zip(letters, self._letters(letters), strict=True))
        if others:
            new.update(zip(others, self._each(others), strict=True))
        return [new[w] for w in words]

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        out: list[bytes] = []
        held, size = [], 0
        for t in texts:
            data = (t or "").encode("utf-8", "replace")
            held.append(data)
            size += len(data)
            if size > TOGETHER:
                out += self._encode(held)
                held, size = [], 0
        return out + self._encode(held)

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        words = pc.ascii_split_whitespace(_plain_words(texts))
        known = words.values.dictionary_encode()
        ids, at = gathered(
            self._of_words(known.dictionary.to_pylist()), known.indices.to_numpy(), words.offsets.to_numpy()
        )
        at = (4 * at).tolist()
        return [ids[i:j] for i, j in zip(at, at[1:], strict=False)]
