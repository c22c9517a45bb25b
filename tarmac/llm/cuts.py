"""Words of many texts at once, by classes of bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BREAK, BLANK, WORD = 0, 1, 2


@dataclass(frozen=True)
class Words:
    """The words of a batch of texts in order, the number of the text each is of, and whether a piece begins with it."""

    words: pa.Array
    text: np.ndarray
    first: np.ndarray


def lowered() -> np.ndarray:
    """Bytes with A-Z in lower case and all others as they are."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def byte_classes(word: bytes = b"", blank: bytes = b"", breaks: bytes = b"", others: int = WORD) -> np.ndarray:
    """The class of each byte; ``others`` is that of the bytes that are not named."""
    table = np.full(256, others, np.uint8)
    for some, kind in ((word, WORD), (blank, BLANK), (breaks, BREAK)):
        table[list(some)] = kind
    return table


def cut(texts: pa.Array, classes: np.ndarray) -> Words:
    """Longest runs of word bytes, A-Z in lower case; null is an empty text.

    Classes of bytes are enough, as all bytes of a character beyond ASCII are of one class.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    none = np.zeros(0, np.int64)
    if not len(texts) or bounds[-1] == bounds[0]:
        return Words(pa.array([], pa.large_string()), none, none.astype(bool))
    data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    kinds = classes[data]
    inside = kinds == WORD
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    # A text begins a word of its own.
    heads = bounds[:-1][(bounds[:-1] < bounds[1:])]
    begin[heads] = inside[heads]
    tails = heads[heads > 0] - 1
    end[tails] = inside[tails]
    starts, stops = np.flatnonzero(begin), np.flatnonzero(end) + 1
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(stops - starts)])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(lowered()[data][inside]))
    text = np.searchsorted(bounds, starts, side="right") - 1
    piece = np.cumsum(kinds == BREAK)[starts]
    first = np.ones(len(starts), bool)
    first[1:] = (piece[1:] != piece[:-1]) | (text[1:] != text[:-1])
    return Words(words, text, first)
