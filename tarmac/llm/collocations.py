"""Collocations: phrases whose words stand together more often than by chance.

Texts are cut into pieces and words once and written as chunks: the different words of some texts
of one language, and the place of each word of the text in that list. All counting reads these chunks.

Phrases grow by a word a level, from single words on, and a level is one reading. Words are counted as they are.
Then a double-array trie of the frequent phrases of a level is broadcast, and numpy takes all positions of a chunk through it at once,
a word a step. What is counted are pairs of an accepting state and the word behind it, which are the phrases of one word more. A
phrase can be frequent only if the two phrases that are a word shorter are, so pairs are left out where no phrase of the trie begins a word later.

Tasks add up what they read and send pairs as numbers, in order and as differences, dealt out by hash; the number of parts grows with the
words of the corpus. So a level costs one reading and the sending of its different pairs, however many of them turn out to be rare.

A trie holds ``MOST_PHRASES`` phrases and ``MOST_BYTES`` bytes at most; beyond that frequent phrases are dealt out by hash
to several tries, a reading each, so that what is broadcast does not grow with the corpus.
With several tries a position knows only the front of the two shorter phrases, and the word behind is any frequent one. These
are a list of ``MOST_WORDS`` words and ``MOST_BYTES`` bytes at most; beyond that there are several lists, a reading each.

Scores: see :func:`scored`. All counts are whole numbers; products are decimals of 38 digits, enough for 10^15 words.

Null texts are empty; a null language is ``und``. Empty texts and tables have no phrases. Equal rows count as often
as they stand there. Equal scores are ordered by count, then by phrase, so there are no ties. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import column, stored
from tarmac.llm.cuts import byte_classes, cut
from tarmac.operators.joins import shuffle_partitions

# What parts words and pieces, the name of no language, and the longest phrase.
BLANKS = b"\x20\x09"
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
NO_LANGUAGE = "und"
LONGEST = 5

CHUNK_BYTES = 500_000
MOST_PHRASES = 1_200_000
MOST_WORDS = 4_000_000
MOST_BYTES = 64_000_000
FEW_WORDS = 0xFFFF
MOST_HELD = 1 << 20
WORDS_A_PARTITION = 1 << 21
BYTES_A_WORD = 16
PIECES = 64


# Chunks


@dataclass(frozen=True)
class Chunk:
    """Different words with a hash of each, and the words of some texts as places in them, -1 before each piece."""

    lang: str
    words: pa.Array
    hashes: np.ndarray
    codes: np.ndarray


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), np.uint32, len(words))


def chunks(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Chunks as rows. ``words`` is one text with a line for each word, as no word holds a line break."""
    classes = byte_classes(blank=BLANKS, breaks=BREAKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("lang")
            for name in pc.unique(names).to_pylist():
                texts = batch.column("text").filter(pc.equal(names, name))
                upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
                start = 0
                while start < len(texts):
                    before = upto[start - 1] if start else 0
                    stop = min(len(texts), int(np.searchsorted(upto, before + CHUNK_BYTES)) + 1)
                    found = cut(texts.slice(start, stop - start), classes)
                    start = stop
                    n = len(found.words)
                    if not n:
                        continue
                    coded = found.words.dictionary_encode()
                    # Short numbers where they do; the highest is -1.
                    codes = np.full(n + int(found.first.sum()), -1, np.int32 if len(coded.dictionary) >= FEW_WORDS else np.int16)
                    codes[np.arange(n) + np.cumsum(found.first)] = coded.indices.to_numpy().astype(codes.dtype)
                    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
                    hashes = hashes_of(words)
                    row = [[name], [b"".join(w + b"\n" for w in words).decode()], [hashes.tobytes()], [codes.tobytes()], [n]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in row], ["lang", "words", "hashes", "codes", "n"])

    rows = docs.select(column(text).cast("string").alias("text"), F.coalesce(column(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"))
    return rows.mapInArrow(run, "lang string, words string, hashes binary, codes binary, n long")


def lines_of(text: pa.Buffer) -> pa.Array:
    data = np.frombuffer(text, np.uint8)
    ends = np.flatnonzero(data == 10)
    offsets = np.concatenate([[0], ends - np.arange(len(ends))]).astype(np.int32)
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(data[data != 10]))


def read_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    for batch in batches:
        for i in range(batch.num_rows):
            lang, text, hashes, codes = (batch.column(c)[i] for c in ("lang", "words", "hashes", "codes"))
            words = lines_of(text.as_buffer())
            if len(words) >= FEW_WORDS:
                places = np.frombuffer(codes.as_buffer(), np.int32)
            else:
                places = np.frombuffer(codes.as_buffer(), np.uint16).astype(np.int32)
                places[places == FEW_WORDS] = -1
            yield Chunk(lang.as_py(), words, np.frombuffer(hashes.as_buffer(), np.uint32), places)


# Tries


@dataclass(frozen=True)
class Lexicon:
    """Different words in order of their hashes."""

    words: pa.Array
    hashes: np.ndarray

    def places(self, c: Chunk) -> np.ndarray:
        """The place here of each word of a chunk, and -1 for those that are not here and for what stands between pieces."""
        hashes = c.hashes if len(c.hashes) else hashes_of(c.words.cast(pa.large_binary()).to_pylist())
        places = np.full(len(hashes) + 1, -1, np.int32)
        left, at = np.arange(len(hashes)), np.searchsorted(self.hashes, hashes)
        # Words of one hash stand side by side; few hashes have more than one.
        while len(left):
            good = self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes[left]
            good &= at < len(self.hashes)
            left, at = left[good], at[good]
            same = pc.equal(c.words.take(pa.array(left)), self.words.take(pa.array(at))).to_numpy(zero_copy_only=False)
            places[left[same]] = at[same]
            left, at = left[~same], at[~same] + 1
        return places


def lexicon(words: pa.Array) -> tuple[Lexicon, np.ndarray]:
    """The lexicon of different words, and the place of each in it."""
    hashes = hashes_of(words.cast(pa.large_binary()).to_pylist())
    order = np.argsort(hashes, kind="stable")
    places = np.empty(len(order), np.int64)
    places[order] = np.arange(len(order))
    return Lexicon(words.take(pa.array(order)), hashes[order]), places


@dataclass(frozen=True)
class Trie:
    """A double array: the child of state ``s`` by symbol ``c`` is ``t = base[s] + c`` if ``check[t] == s``.

    The first symbol of a phrase is its language. A word is two symbols, its place in ``words`` divided by ``radix`` and the
    rest, so that no state has more than ``radix`` children and the array is filled well. All phrases have ``depth`` words.
    """

    base: np.ndarray
    check: np.ndarray
    leaf: np.ndarray  # number of the phrase that ends in a state, else -1
    words: Lexicon
    langs: dict[str, int]
    depth: int
    radix: int

    def walk(self, c: Chunk, places: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Positions at which a phrase stands, and the states that accept there. ``places`` are those of the chunk's words, if known."""
        at = np.zeros(0, np.int64)
        if c.lang not in self.langs:
            return at, at
        places = self.words.places(c) if places is None else places
        # A word that is not in the trie leads to the place behind the array, which is nobody's child.
        beyond = np.int32(len(self.check))
        high = np.where(places < 0, beyond, places // self.radix)[c.codes]
        low = np.where(places < 0, 0, places % self.radix)[c.codes]
        at = np.flatnonzero(high[: max(0, len(high) - self.depth + 1)] < beyond)
        state = np.full(len(at), self.base[0] + self.langs[c.lang], np.int32)
        for step in range(2 * self.depth):
            symbol = (low if step % 2 else high)[at + step // 2]
            to = np.minimum(self.base[state] + symbol, beyond - 1)
            found = self.check[to] == state
            at, state = at[found], to[found]
        return at, state


def double_array(langs: list[str], phrases: list[list[str]]) -> Trie:
    """The trie of phrases of equal length, with their languages; phrase ``i`` is leaf ``i``."""
    return flat_double_array(pa.array(langs, pa.string()), pa.array([w for p in phrases for w in p], pa.string()))


def flat_double_array(langs: pa.Array, words: pa.Array) -> Trie:
    """The same of the words of all phrases, one after the other."""
    n, depth = len(langs), len(words) // len(langs)
    coded, named = words.dictionary_encode(), langs.dictionary_encode()
    names = {name: i for i, name in enumerate(named.dictionary.to_pylist())}
    known, place = lexicon(coded.dictionary)
    radix = int(np.ceil(len(place) ** 0.5)) + 1
    places = place[coded.indices.to_numpy()].reshape(-1, depth)
    symbols = [named.indices.to_numpy().astype(np.int64)]
    for j in range(depth):
        symbols += np.divmod(places[:, j], radix)
    most = max(radix, len(names))
    # Nodes level by level: parent and symbol of each; node 0 is the root.
    parents, labels, node, nodes = [np.array([0])], [np.array([0])], np.zeros(n, np.int64), 1
    for symbol in symbols:
        keys, place = np.unique(node * most + symbol, return_inverse=True)
        parents.append(keys // most)
        labels.append(keys % most)
        node = place + nodes
        nodes += len(keys)
    parent, label = np.concatenate(parents), np.concatenate(labels)
    base, slot, length = _placed(parent, label, most)
    check, bases, leaf = np.full(length, -1, np.int32), np.zeros(length, np.int32), np.full(length, -1, np.int32)
    bases[slot] = base
    check[slot[1:]] = slot[parent[1:]]
    leaf[slot[node]] = np.arange(n)
    return Trie(bases, check, leaf, known, names, depth, radix)


def _placed(parent: np.ndarray, label: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The base and the slot of each node, and the length of the array, in which any base and symbol stay.

    Children are in the order of their parents. Nodes of like numbers of children, largest first, are all put at drawn bases
    at once; those that meet no slot in use and no other stay, the rest are drawn again. Nodes of one child take what is free.
    """
    n = len(parent)
    owner, first, size = np.unique(parent[1:], return_index=True, return_counts=True)
    first += 1
    draw = np.random.default_rng(1)
    used = np.zeros(n + n // 2 + 4 * most, bool)
    used[0] = True
    base, slot = np.zeros(n, np.int64), np.zeros(n, np.int64)
    kind = np.where(size > 1, np.ceil(np.log2(size)), 0).astype(int)
    claims, poor = np.empty(len(used), np.int32), 0
    for k in sorted(set(kind[kind > 0].tolist()), reverse=True):
        left = np.flatnonzero(kind == k)
        while len(left):
            number = size[left]
            children = np.repeat(first[left] - np.cumsum(number) + number, number) + np.arange(number.sum())
            of = np.repeat(np.arange(len(left)), number)
            at = draw.integers(1, len(used) - most, len(left))
            slots = at[of] + label[children]
            claims[slots] = of
            bad = np.zeros(len(left), bool)
            bad[of[used[slots] | (claims[slots] != of)]] = True
            good = ~bad[of]
            used[slots[good]] = True
            slot[children[good]] = slots[good]
            base[owner[left[~bad]]] = at[~bad]
            poor = poor + 1 if bad.mean() > 0.9 else 0
            if poor == 8:
                used, poor = np.append(used, np.zeros(len(used) // 4, bool)), 0
                claims = np.empty(len(used), np.int32)
            left = left[bad]
    alone = np.flatnonzero(kind == 0)
    children = first[alone]
    # From the back of the free slots a base is never below zero.
    free = np.flatnonzero(~used[most:])[: len(alone)] + most
    free = np.append(free, np.arange(len(used), len(used) + len(alone) - len(free)))
    slot[children] = free
    base[owner[alone]] = free - label[children]
    return base, slot, max(len(used), int(slot.max()) + 1) + most


def parts_of(rows: DataFrame, by: list[str], most: int) -> Iterator[tuple[pa.Table, bool]]:
    """A stored table in parts of ``most`` rows and ``MOST_BYTES`` bytes, and whether it is the only one."""
    size = rows.agg(F.count("*").alias("n"), F.sum(sum(F.octet_length(c) for c in by)).alias("bytes")).first()
    if not size["n"]:
        return
    parts = max(-(-size["n"] // most), -(-size["bytes"] // MOST_BYTES))
    dealt = rows.select(*by).withColumn("part", F.pmod(F.xxhash64(*by), F.lit(parts)))
    for part in range(parts):
        some = dealt.where(F.col("part") == part).select(*by).toArrow()
        if some.num_rows:
            yield some, parts == 1


def tries(phrases: DataFrame) -> Iterator[tuple[tuple[Trie, pa.Array, pa.Array], bool]]:
    """Tries of a stored table of ``lang`` and ``phrase``, with the phrases and languages of their leaves, and whether it is the only one."""
    for some, only in parts_of(phrases, ["lang", "phrase"], MOST_PHRASES):
        texts, langs = some["phrase"].combine_chunks(), some["lang"].combine_chunks()
        yield (flat_double_array(langs, pc.split_pattern(texts, " ").flatten()), texts, langs), only


# Levels


def pressed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def unpressed(data: pa.Buffer) -> bytes:
    return pa.decompress(data.slice(8), int.from_bytes(data.slice(0, 8).to_pybytes(), "little"), "zstd", asbytes=True)


def pressed_numbers(numbers: np.ndarray) -> bytes:
    """Whole numbers by bytes of like weight, as the high ones are mostly zero."""
    return pressed(numbers.astype(np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes())


def unpressed_numbers(data: pa.Buffer) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(unpressed(data), np.uint8).reshape(8, -1).T).view(np.uint64).reshape(-1)


def batches_of(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == 256:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def slices_of(columns: list[pa.Array], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(columns[0]), 1 << 16):
        yield pa.RecordBatch.from_arrays([c.slice(start, 1 << 16).cast(f.type) for c, f in zip(columns, schema)], schema=schema)


FOUND = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])
DEALT_WORDS = pa.schema([("part", pa.int32()), ("lang", pa.string()), ("words", pa.binary()), ("counts", pa.binary())])
DEALT_PAIRS = pa.schema([("part", pa.int32()), ("pairs", pa.binary()), ("counts", pa.binary())])


def frequent_words(texts: DataFrame, partitions: int, least: int) -> DataFrame:
    """``lang``, ``phrase`` and ``f`` of words that stand ``least`` times or more."""
    parts = 2 * partitions

    def added_up(tables: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(tables).group_by("word").aggregate([("hash", "min"), ("f", "sum")]).rename_columns(["word", "hash", "f"])

    def dealt(lang: str, tables: list[pa.Table]) -> Iterator[tuple]:
        table = added_up(tables).sort_by("hash")
        words, counts = table["word"].to_pylist(), table["f"].to_numpy()
        part = (table["hash"].to_numpy().astype(np.uint64) * np.uint64(parts)) >> np.uint64(32)
        bounds = np.flatnonzero(np.diff(part, prepend=parts, append=parts)).tolist()
        for a, b in zip(bounds, bounds[1:]):
            text = "".join([w + "\n" for w in words[a:b]]).encode()
            yield int(part[a]), lang, pressed(text), pressed_numbers(counts[a:b])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            held: dict[str, list[pa.Table]] = {}
            size = 0
            for c in read_chunks(batches):
                counts = np.bincount(c.codes[c.codes >= 0], minlength=len(c.words))
                table = pa.table({"word": c.words, "hash": c.hashes, "f": counts})
                held.setdefault(c.lang, []).append(table)
                size += table.nbytes
                if size > MOST_HELD * BYTES_A_WORD:
                    for lang, tables in held.items():
                        yield from dealt(lang, tables)
                    held, size = {}, 0
            for lang, tables in held.items():
                yield from dealt(lang, tables)

        return batches_of(rows(), DEALT_WORDS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Table]] = {}
        size: dict[str, int] = {}
        for batch in batches:
            for lang, words, counts in zip(batch.column("lang").to_pylist(), batch.column("words"), batch.column("counts")):
                word, f = lines_of(pa.py_buffer(unpressed(words.as_buffer()))), unpressed_numbers(counts.as_buffer()).astype(np.int64)
                some = held.setdefault(lang, [])
                some.append(pa.table({"word": word, "hash": np.zeros(len(f), np.uint32), "f": f}))
                size[lang] = size.get(lang, 0) + some[-1].nbytes
                # What was added up before counts twice, so that it is not added up over and over.
                if size[lang] > MOST_HELD * BYTES_A_WORD + 2 * some[0].nbytes:
                    held[lang], size[lang] = [added_up(some)], 0
        for lang, tables in held.items():
            table = added_up(tables)
            table = table.filter(pc.greater_equal(table["f"], least)).combine_chunks()
            if table.num_rows:
                words, f = table["word"].combine_chunks(), table["f"].combine_chunks()
                yield from slices_of([pa.repeat(lang, len(words)), words, f], FOUND)

    rows = texts.mapInArrow(count, "part int, lang string, words binary, counts binary").repartition(partitions, "part")
    return rows.mapInArrow(add, "lang string, phrase string, f long")


def pairs(c: Chunk, trie: Trie, only: bool, after: Lexicon) -> np.ndarray:
    """A number for each phrase of one word more than the trie's that stands in a chunk and may be frequent: its front's leaf, and the place of its last word."""
    places = trie.words.places(c)
    at, state = trie.walk(c, places)
    last = (places if only else after.places(c))[np.append(c.codes, np.int32(-1))[at + trie.depth]]
    good = last >= 0
    if only:
        here = np.zeros(len(c.codes) + 1, bool)
        here[at] = True
        good &= here[at + 1]
    return trie.leaf[state[good]].astype(np.uint64) * np.uint64(len(after.words)) + last[good].astype(np.uint64)


def summed(numbers: list[np.ndarray], counts: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different numbers in order, and the sum of the counts of each, which are 1 if not given."""
    every = np.concatenate(numbers)
    if counts is None:
        every.sort()
        first = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
        return every[first], np.diff(first, append=len(every))
    order = np.argsort(every)
    every = every[order]
    first = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
    return every[first], np.add.reduceat(np.concatenate(counts)[order], first)


# An odd number, so that multiplying by it puts the numbers below a power of two in another order; the product of the two is 1.
MIX = 0x9E3779B97F4A7C15
UNMIX = pow(MIX, -1, 1 << 64)


def longer(texts: DataFrame, shared, only: bool, partitions: int, least: int) -> DataFrame:
    """``lang``, ``phrase`` and ``f`` of phrases of one word more than the trie's that stand ``least`` times or more.

    Numbers of pairs are mixed within the least power of two above them, so high bits deal them out, and differences in a part stay small.
    """
    parts = 2 * partitions

    def bits(trie: Trie, phrases: pa.Array, after: Lexicon) -> int:
        return max(1, (len(phrases) * len(after.words) - 1).bit_length())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, phrases, _, after = shared.value
        after = after or trie.words
        high = bits(trie, phrases, after)
        low = max(0, high - 20)

        def dealt(held: list[np.ndarray]) -> Iterator[tuple]:
            mixed, counts = summed(held)
            part = ((mixed >> np.uint64(low)) * np.uint64(parts)) >> np.uint64(high - low)
            bounds = np.flatnonzero(np.diff(part, prepend=parts, append=parts)).tolist()
            for a, b in zip(bounds, bounds[1:]):
                yield int(part[a]), pressed_numbers(np.diff(mixed[a:b], prepend=np.uint64(0))), pressed_numbers(counts[a:b])

        def rows() -> Iterator[tuple]:
            held, size = [], 0
            for c in read_chunks(batches):
                held.append((pairs(c, trie, only, after) * np.uint64(MIX)) & np.uint64((1 << high) - 1))
                size += len(held[-1])
                if size > MOST_HELD:
                    yield from dealt(held)
                    held, size = [], 0
            if size:
                yield from dealt(held)

        return batches_of(rows(), DEALT_PAIRS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts, size = [], [], 0
        for batch in batches:
            for some, n in zip(batch.column("pairs"), batch.column("counts")):
                held.append(np.cumsum(unpressed_numbers(some.as_buffer()), dtype=np.uint64))
                counts.append(unpressed_numbers(n.as_buffer()).astype(np.int64))
                size += len(held[-1])
                if size > MOST_HELD + 2 * len(held[0]):
                    held, counts, size = *([x] for x in summed(held, counts)), 0
        if not held:
            return
        mixed, f = summed(held, counts)
        mixed, f = mixed[f >= least], f[f >= least]
        if not len(f):
            return
        trie, phrases, langs, after = shared.value
        after = after or trie.words
        number = (mixed * np.uint64(UNMIX)) & np.uint64((1 << bits(trie, phrases, after)) - 1)
        leaf, last = np.divmod(number, np.uint64(len(after.words)))
        front = phrases.take(pa.array(leaf))
        yield from slices_of([langs.take(pa.array(leaf)), pc.binary_join_element_wise(front, after.words.take(pa.array(last)), " "), pa.array(f)], FOUND)

    rows = texts.mapInArrow(count, "part int, pairs binary, counts binary").repartition(partitions, "part")
    return rows.mapInArrow(add, "lang string, phrase string, f long")


def united(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def phrase_counts(texts: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """``lang``, ``phrase``, its number of ``words`` and ``f`` of frequent phrases, and ``lang`` and its number ``n`` of words."""
    context = texts.sparkSession.sparkContext
    sizes = stored(texts.groupBy("lang").agg(F.sum("n").alias("n")))
    n = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    partitions = max(shuffle_partitions(texts.sparkSession), -(-n // WORDS_A_PARTITION))
    single = stored(frequent_words(texts, partitions, least))
    found, frequent, words = [single.withColumn("words", F.lit(1))], single, None
    for k in range(2, LONGEST + 1):
        levels = []
        for trie, only in tries(frequent):
            if not only and words is None:
                words = stored(single.select(F.col("phrase").alias("word")).distinct())
            for after in [None] if only else (lexicon(some["word"].combine_chunks())[0] for some, _ in parts_of(words, ["word"], MOST_WORDS)):
                shared = context.broadcast((*trie, after))
                levels.append(stored(longer(texts, shared, only, partitions, least)))
                shared.unpersist()
        if not levels:
            break
        frequent = united(levels)
        found.append(frequent.withColumn("words", F.lit(k)))
    return united(found), sizes


def collocations(
    docs: DataFrame, least: int = 100, best: int = 2000, share: int = 100, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score`` of the ``best`` phrases of each language."""
    counts, sizes = phrase_counts(stored(chunks(docs, text, lang)), least)
    rows = scored(stored(counts), sizes, share)
    order: Callable[[list[str]], Window] = lambda keys: Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), "phrase")
    # In pieces first, so that no task ranks all phrases of a language.
    piece = F.pmod(F.xxhash64("phrase"), F.lit(PIECES))
    rows = rows.withColumn("piece", piece).withColumn("rank", F.row_number().over(order(["lang", "piece"]))).where(F.col("rank") <= best)
    rows = rows.withColumn("rank", F.row_number().over(order(["lang"])).cast("long")).where(F.col("rank") <= best)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def scored(counts: DataFrame, sizes: DataFrame, share: int) -> DataFrame:
    """Phrases with their score: ``floor(1000 a n / (l r))`` of the cut at which that is lowest.

    ``l`` and ``r`` are the counts of the parts before and after the cut. Phrases that stand in a phrase of one more
    word with ``share`` percent of their count or more are left out; longer ones cannot stand there more often.
    """
    f = counts.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    phrases = counts.where("words > 1")
    tail = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    head = F.expr("substring_index(phrase, ' ', words - 1)")
    parts = phrases.where("words > 2").select("lang", "f", F.explode(F.array_distinct(F.array(head, tail))).alias("phrase"))
    around = parts.groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    kept = phrases.join(around, ["lang", "phrase"], "left").where(F.expr(f"around is null or 100 * around < {share} * f"))
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.expr("sequence(1, words - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k",
        F.expr("substring_index(phrase, ' ', k)").alias("left"),
        F.expr("substring_index(phrase, ' ', k - words)").alias("right"),
    )
    cuts = cuts.join(f.withColumnsRenamed({"part": "left", "part_f": "l"}), ["lang", "left"])
    cuts = cuts.join(f.withColumnsRenamed({"part": "right", "part_f": "r"}), ["lang", "right"])
    cuts = cuts.join(sizes, "lang")
    exact = "(cast(1000 * a as decimal(19, 0)) * cast(n as decimal(18, 0))) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))"
    least = F.min(F.struct(F.expr(exact).alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "a", "n").agg(least).select("lang", "phrase", "a", "n", "cut.l", "cut.r", "cut.score")
