"""Pre-tokens of many texts at once, for texts within Latin-1, by array operations.

A token file says with a regular expression where a text is cut.  For the two
expressions below the cuts depend on the class of each character, the one before
and the one after, so whole slices of a table are cut with a few array
operations.  Texts with other characters go through the tokenizer library.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: The expressions that the two functions follow (fixed values).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BYTES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_SPACE, _LETTER, _DIGIT, _OTHER, _BETWEEN = range(5)
#: Latin-1 characters by class (fixed values).
_SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0]
_DIGITS = [*range(0x30, 0x3A), 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]
_CLASS = np.array(
    [
        _SPACE if c in _SPACES else _DIGIT if c in _DIGITS else _LETTER if chr(c).isalpha() else _OTHER
        for c in range(256)
    ],
    np.uint8,
)
_LOWER = bytes(ord(chr(c).lower()) for c in range(256))


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters of all texts, each text with one place after it; their classes; where the texts end."""
    chars = np.frombuffer(b"\n".join([*texts, b"\n\n"]), np.uint8)[:-1]
    kind = _CLASS[chars]
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    kind[ends] = _BETWEEN
    kind[-1] = _BETWEEN
    return chars, kind, ends


def _contractions(chars: np.ndarray, kind: np.ndarray, start: np.ndarray) -> None:
    """A token that would begin with an apostrophe before certain letters is those letters and the apostrophe."""
    at = np.flatnonzero((chars == 0x27) & start)
    at = at[at + 2 < len(chars)]
    one, two = chars[at + 1], chars[at + 2]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    long &= kind[at + 2] == _LETTER
    hit = (short | long) & (kind[at + 1] == _LETTER)
    at, width = at[hit], np.where(short[hit], 1, 2)
    start[at + 1] = False
    after = at + 1 + width
    start[after] |= kind[after] == _LETTER


def _tokens(chars: np.ndarray, start: np.ndarray, keep: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The tokens, and how many each text has."""
    counts = np.diff(np.r_[0, np.searchsorted(np.flatnonzero(start), ends)])
    data = np.ascontiguousarray(chars[keep])
    offsets = np.append(np.flatnonzero(start[keep]), len(data)).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers), counts


def split_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Tokens of the lower-cased texts by ``WORDS``; white space is dropped."""
    chars, kind, ends = _joined([t.translate(_LOWER) for t in texts])
    start = kind != np.r_[np.uint8(_BETWEEN), kind[:-1]]
    start |= kind == _DIGIT
    keep = (kind != _SPACE) & (kind != _BETWEEN)
    start &= keep
    _contractions(chars, kind, start)
    return _tokens(chars, start, keep, ends)


def split_bytes(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Tokens of the texts by ``BYTES``; every character is in one."""
    chars, kind, ends = _joined(texts)
    start = kind != np.r_[np.uint8(_BETWEEN), kind[:-1]]
    keep = kind != _BETWEEN
    # Of white space before something else the last is apart, and a blank goes with what follows.
    last = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & keep[1:])
    start[last] = True
    start[last[chars[last] == 0x20] + 1] = False
    start &= keep
    _contractions(chars, kind, start)
    return _tokens(chars, start, keep, ends)
