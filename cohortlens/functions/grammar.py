"""Token and sentence grammar, as Java regular expressions.

A text is read twice by the regex engine and never by Python: once to cut it
into sentence pieces, once to cut a piece into tokens.  All repeated groups are
possessive, so the engine loops instead of recursing and long texts cannot
overflow its stack.
"""

from __future__ import annotations

# --- fixed values: abbreviations whose dot does not end a sentence ----------
ABBREVIATIONS = ("Dr.", "Mr.", "Mrs.", "e.g.", "i.e.", "vs.", "a.m.", "p.m.")
# ---------------------------------------------------------------------------

SENTENCE_ENDERS = (".", "!", "?")

_ABBR = "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS)
_WORD = r"\p{L}[\p{L}\p{N}]*+"
_NUMBER = r"\p{N}++(?:[.,]\p{N}++)*+"
# One blank after a token is a separator and travels with the token; any other
# whitespace run is a token of its own.
_BLANK = r"(?: (?!\s))?+"

#: group 1 is the token, group 0 the token with its separator
TOKEN = rf"({_ABBR}|{_WORD}|{_NUMBER}|\s++|[^\s\p{{L}}\p{{N}}]){_BLANK}"

#: tokens per piece; bounds every per-piece array regardless of text length
PIECE_TOKENS = 256

_PLAIN = rf"(?:{_ABBR}|{_WORD}|{_NUMBER}|\s++|[^\s\p{{L}}\p{{N}}.!?])"
_TAIL = rf"[.!?]{_BLANK}(?:\p{{P}}{_BLANK}){{0,{PIECE_TOKENS}}}+"

#: a sentence, or the next PIECE_TOKENS tokens of a very long one; the pieces
#: of a text put together are the text
PIECE = rf"(?:{_PLAIN}{_BLANK}){{1,{PIECE_TOKENS}}}+(?:{_TAIL})?+|{_TAIL}"

#: finds the end of a sentence at the end of a piece
PIECE_ENDS = (
    r"(?<!\b(?:" + "|".join(a[:-1].replace(".", r"\.") for a in ABBREVIATIONS) + r"))"
    r"[.!?] ?(?:\p{P} ?)*$"
)

#: separator between the tokens of a phrase key
KEY_SEP = "\x1f"
