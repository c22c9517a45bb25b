"""SentencePiece BPE encoding in vectorised merge rounds, and decoding.

A text is cut into words (blanks with what follows them, line breaks by themselves) across
which no piece of the vocabulary reaches. The distinct words of many texts are encoded
together: all their characters are one flat array of symbols, cut further wherever no
piece holds two neighbouring characters side by side. Each round looks up the rank of
every pair of neighbours, takes the least rank per segment, merges its leftmost
non-overlapping occurrences in all segments at once, and drops finished segments, until no
pair is left. The library merges one pair after the other; merging several at once is the
same unless a merge makes a pair of no higher rank. Segments where that happens are
encoded again one merge a round.

Unknown characters become their UTF-8 bytes. Decoding is the library's own ``decode``.
The tables of the model, of fixed size, travel with the job, so executors need no file.

Nulls: a null text is empty and has no ids. Texts are encoded whole whatever their length;
memory follows the longest text and ``CHUNK`` bytes. Equal texts give equal ids. An
empty table gives an empty result. Further columns pass through in ``row``.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import column, packed, text_chunks

CHUNK = 1_000_000
CACHED_WORDS = 100_000
NEVER = 2**31 - 1
WORD = re.compile(r" *[^ \n]+| +|\n")
BLANK = "▁"


class HashTable:
    """Places of a fixed set of keys, looked up for whole arrays."""

    def __init__(self, keys: list[int]):
        self.bits = max(4, int(len(keys) * 8).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.places = np.zeros(1 << self.bits, np.int32)
        slots = self._slots(np.array(keys, np.int64)).tolist()
        for place, (key, slot) in enumerate(zip(keys, slots)):
            while self.keys[slot] >= 0:
                slot = (slot + 1) % len(self.keys)
            self.keys[slot], self.places[slot] = key, place

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 if it is not in the set."""
        slots = self._slots(keys)
        seen = self.keys[slots]
        result = np.where(seen == keys, self.places[slots], np.int32(-1))
        open_ = np.flatnonzero((seen != keys) & (seen >= 0))
        slots = slots[open_]
        while len(open_):
            slots = (slots + 1) % len(self.keys)
            seen = self.keys[slots]
            hit = seen == keys[open_]
            result[open_[hit]] = self.places[slots[hit]]
            more = ~hit & (seen >= 0)
            open_, slots = open_[more], slots[more]
        return result


@dataclass(frozen=True)
class Vocabulary:
    """Tables of a model. Symbols are pieces by id, then characters that occur only inside pieces."""

    model: bytes
    n_pieces: int
    symbol_of: np.ndarray  # by code point, -1 if unknown
    n_symbols: int
    pairs: HashTable  # left symbol * n_symbols + right symbol
    pair_ranks: np.ndarray
    pair_symbols: np.ndarray
    neighbours: HashTable  # left code point << 21 | right code point
    byte_ids: tuple[int, ...]


def load_vocabulary(path: str) -> Vocabulary:
    """Read a BPE model with byte fallback, an identity normaliser and a dummy prefix."""
    model = Path(path).read_bytes()
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    n = sp.get_piece_size()
    texts = [sp.id_to_piece(i) for i in range(n)]
    plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    if sp.normalize(" a  b ") != f"{BLANK}{BLANK}a{BLANK}{BLANK}b{BLANK}" or any("\n" in texts[i] for i in plain):
        raise ValueError("only models that keep white space, with a dummy prefix and no line breaks in pieces")
    if any(BLANK in texts[i].lstrip(BLANK) for i in plain):
        raise ValueError("a piece of the model reaches over a blank")
    ids = {texts[i]: i for i in plain}
    for c in sorted({c for t in ids for c in t} - set(ids)):
        ids[c] = len(texts)
        texts.append(c)
    symbol_of = np.full(0x110000, -1, np.int32)
    for t, i in ids.items():
        if len(t) == 1:
            symbol_of[ord(t)] = i
    symbol_of[ord(" ")] = symbol_of[ord(BLANK)]
    # Equal scores are equal ranks: the leftmost pair goes first among them.
    order = {s: r for r, s in enumerate(sorted({-sp.get_score(i) for i in plain}))}
    pairs = {}
    for i in plain:
        t = texts[i]
        for k in range(1, len(t)):
            left, right = ids.get(t[:k]), ids.get(t[k:])
            if left is not None and right is not None:
                pairs[left * len(texts) + right] = (order[-sp.get_score(i)], i)
    found = np.array(list(pairs.values()), np.int32).reshape(-1, 2)
    beside = {(ord(a) << 21) | ord(b) for i in plain for a, b in zip(texts[i], texts[i][1:])}
    return Vocabulary(
        model, n, symbol_of, len(texts), HashTable(list(pairs)), found[:, 0].copy(), found[:, 1].copy(),
        HashTable(sorted(beside)), tuple(sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)),
    )


def merge_rounds(v: Vocabulary, symbols: np.ndarray, segments: np.ndarray, single: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge the symbols of each segment as far as they go.

    Returns the places of the symbols that are left, the symbols, and the segments that need
    to be done again with ``single``, one merge per segment and round.
    """
    places = np.arange(len(symbols))
    last_rank = np.full(segments[-1] + 1 if len(segments) else 0, -1, np.int32)
    several = np.zeros(len(last_rank), bool)
    again = np.zeros(len(last_rank), bool)
    done = []
    while len(symbols):
        starts = np.flatnonzero(np.r_[True, segments[1:] != segments[:-1]])
        names = segments[starts]
        keys = symbols[:-1].astype(np.int64) * v.n_symbols + symbols[1:]
        at = v.pairs.find(keys)
        known = (at >= 0) & (segments[1:] == segments[:-1]) & (symbols[:-1] >= 0) & (symbols[1:] >= 0)
        ranks = np.full(len(symbols), NEVER, np.int32)
        ranks[:-1][known] = v.pair_ranks[at[known]]
        least = np.minimum.reduceat(ranks, starts)
        again[names[several[names] & (least <= last_rank[names])]] = True
        last_rank[names] = least
        sizes = np.diff(np.r_[starts, len(symbols)])
        best = np.flatnonzero((ranks == np.repeat(least, sizes)) & (ranks < NEVER))
        # Of pairs that overlap in a row, every second one stays.
        first = np.flatnonzero(np.r_[True, best[1:] != best[:-1] + 1]) if len(best) else best
        nth = np.arange(len(best)) - np.repeat(first, np.diff(np.r_[first, len(best)]))
        best = best[nth % 2 == 0]
        new_segment = np.r_[True, segments[best[1:]] != segments[best[:-1]]] if len(best) else np.zeros(0, bool)
        if single:
            best = best[new_segment]
        else:
            several[:] = False
            several[segments[best[~new_segment]]] = True
        symbols[best] = v.pair_symbols[at[best]]
        keep = np.ones(len(symbols), bool)
        keep[best + 1] = False
        finished = np.repeat(least == NEVER, sizes)
        done.append((places[finished], symbols[finished]))
        keep &= ~finished
        places, symbols, segments = places[keep], symbols[keep], segments[keep]
    if not done:
        return places, symbols, np.zeros(0, np.int64)
    places, symbols = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(places, kind="stable")
    return places[order], symbols[order], np.flatnonzero(again)


def encode_words(v: Vocabulary, words: list[str]) -> list[tuple[int, ...]]:
    """Ids of words, in which blanks stand for themselves."""
    if not words:
        return []
    code_points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    word_starts = np.cumsum([0, *map(len, words)])
    blank = np.where(code_points == ord(" "), ord(BLANK), code_points)
    beside = v.neighbours.find((blank[:-1] << 21) | blank[1:]) >= 0
    cut = np.r_[True, ~beside]
    cut[word_starts[:-1]] = True
    segments = np.cumsum(cut) - 1
    initial = v.symbol_of[code_points]
    places, symbols, again = merge_rounds(v, initial.copy(), segments)
    if len(again):
        redo = np.flatnonzero(np.isin(segments, again))
        other = ~np.isin(segments[places], again)
        _, compact = np.unique(segments[redo], return_inverse=True)
        more_places, more_symbols, _ = merge_rounds(v, initial[redo].copy(), compact, single=True)
        places = np.r_[places[other], redo[more_places]]
        symbols = np.r_[symbols[other], more_symbols]
        order = np.argsort(places, kind="stable")
        places, symbols = places[order], symbols[order]
    bounds = np.searchsorted(places, word_starts).tolist()
    # One object for each id, not one for each time it is used.
    ids = list(map(list(range(v.n_symbols)).__getitem__, symbols.tolist()))
    result = []
    odd = (symbols < 0) | (symbols >= v.n_pieces)
    odd_words = set(np.searchsorted(word_starts, places[odd], side="right") - 1)
    for i in range(len(words)):
        a, b = bounds[i], bounds[i + 1]
        if i not in odd_words:
            result.append(tuple(ids[a:b]))
            continue
        spelled: list[int] = []
        for k in range(a, b):
            if odd[k]:
                spelled += [v.byte_ids[byte] for byte in chr(code_points[places[k]]).encode()]
            else:
                spelled.append(ids[k])
        result.append(tuple(spelled))
    return result


class Encoder:
    """Encodes texts, with the ids of words met before at hand (``CACHED_WORDS`` at most)."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.known: dict[str, tuple[int, ...]] = {}

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        # Millions of tuples that refer to nothing: looking for cycles among them takes a third of the time.
        gc.disable()
        try:
            yield from self._encode(texts)
        finally:
            gc.enable()

    def _encode(self, texts: list[str]) -> Iterator[list[int]]:
        cut = [WORD.findall(" " + t.replace(BLANK, " ")) if t else [] for t in texts]
        known, distinct = self.known, set()
        for words in cut:
            distinct.update(words)
        new = list(distinct.difference(known))
        known.update(zip(new, encode_words(self.v, new)))
        for words in cut:
            yield list(chain.from_iterable(map(known.__getitem__, words)))
        for word in new[max(0, CACHED_WORDS - len(known) + len(new)) :]:
            del known[word]


def encoded(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``row`` (all columns) and the ``ids`` of each text."""
    vocabulary = load_vocabulary(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            for start, part in text_chunks(batch.column("text"), CHUNK):
                ids = pa.array(list(encoder.encode(part)), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(start, len(part)), ids], ["row", "ids"])

    rows = docs.select(packed(docs), column(text).alias("text"))
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>")


def decoded(rows: DataFrame, model_path: str) -> DataFrame:
    """``row`` and the ``text`` that the library decodes from ``ids``."""
    model = Path(model_path).read_bytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        for batch in batches:
            texts = [sp.decode(ids) if ids else "" for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    return rows.select("row", "ids").mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, text string")


def round_trip_digests(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``row`` with ``n_tokens`` and the digests of the ids and of the text decoded from them.

    The same as :func:`encoded`, then :func:`decoded`, without moving the ids between tasks' processes.
    """
    vocabulary = load_vocabulary(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        sp = sentencepiece.SentencePieceProcessor(model_proto=vocabulary.model)
        decimal = list(map(str, range(vocabulary.n_pieces)))
        for batch in batches:
            for start, part in text_chunks(batch.column("text"), CHUNK):
                sizes, id_digests, text_digests = [], [], []
                for ids in encoder.encode(part):
                    sizes.append(len(ids))
                    id_digests.append(sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                    text_digests.append(sha256(sp.decode(ids).encode() if ids else b"").hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(start, len(part)), pa.array(sizes, pa.int64()),
                     pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())],
                    ["row", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = docs.select(packed(docs), F.coalesce(column(text), F.lit("")).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
