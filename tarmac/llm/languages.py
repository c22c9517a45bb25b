"""Language of texts by multinomial naive Bayes over hashed character n-grams.

Characters that are no letters become one blank, letters are put in lower case, and a text begins and
ends with a blank. All n-grams of 1 to ``LONGEST`` characters but the lone blank are hashed to a number of
buckets. Learning counts buckets per language over all rows to learn from, in numpy in each task and
added up by Spark. The logarithms of the smoothed shares are a matrix of buckets and languages, which is broadcast: it
has ``CELLS`` cells at most, as the number of buckets falls with the number of languages. Scoring
picks the matrix rows of all n-grams of many texts at once and adds them up text by text.

The score is the probability of the predicted language under the model. Equal ones go to the language that comes first.
A text that is null or has no letter is ``und`` with a score of 0, as is every text if there is nothing to learn from.
Null languages, null texts and texts without letters are not learned from. Equal rows count as often as they stand there.
Texts are read whole, ``CHARACTERS`` at a time. All columns pass through in ``row``. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import column, packed, text_chunks

UNKNOWN = "und"
LONGEST = 4
CELLS = 1 << 23
MOST_BUCKETS = 1 << 17
SMOOTHING = 0.5
CHARACTERS = 250_000
BLANK = 32
# An odd number whose bits are spread evenly.
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def letters() -> np.ndarray:
    """For every code point, the lower case of a letter, or a blank."""
    table = np.full(0x110000, BLANK, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            small = c.lower()
            table[i] = ord(small) if len(small) == 1 else i
    return table


def plain_parts(text: str, table: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Letters and single blanks of a text, about ``CHARACTERS`` at a time, and how many n-grams begin in each part.

    A part is followed by the next ``LONGEST - 1`` characters, so that the n-grams that begin in it are whole.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    plain = table[points]
    keep = plain != BLANK
    if not keep.any():
        return
    # A blank stays where it follows a letter.
    keep[1:] |= plain[:-1] != BLANK
    plain = np.concatenate([[BLANK], plain[keep], [BLANK]]).astype(np.uint32)
    plain = plain[: -1 if plain[-2] == BLANK else None]
    for at in range(0, len(plain), CHARACTERS):
        yield plain[at : at + CHARACTERS + LONGEST - 1], min(CHARACTERS, len(plain) - at)


@dataclass(frozen=True)
class Letters:
    """Characters of some texts put together, the number of the text of each, and whether n-grams begin there."""

    points: np.ndarray
    own: np.ndarray
    begins: np.ndarray

    def n_grams(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the n-grams, and the text of each; no n-gram spans two texts."""
        shift = np.uint64(64 - buckets.bit_length() + 1)
        codes = self.points.astype(np.uint64) + np.uint64(1)
        value, found, texts = np.zeros(len(codes), np.uint64), [], []
        for n in range(1, LONGEST + 1):
            length = len(codes) - n + 1
            if length <= 0:
                break
            value = (value[:length] << np.uint64(16)) ^ (value[:length] >> np.uint64(48)) ^ codes[n - 1 :]
            good = self.begins[:length] & (self.own[:length] == self.own[n - 1 :])
            if n == 1:
                good &= self.points != BLANK
            found.append((((value[good] ^ np.uint64(n)) * SPREAD) >> shift).astype(np.int64))
            texts.append(self.own[:length][good])
        return np.concatenate(found), np.concatenate(texts)


def letter_runs(texts: pa.Array, table: np.ndarray) -> Iterator[Letters]:
    """The letters of a batch of texts, about ``CHARACTERS`` at a time."""
    points, own, begins, size = [], [], [], 0

    def joined() -> Letters:
        return Letters(np.concatenate(points), np.concatenate(own), np.concatenate(begins))

    for start, some in text_chunks(texts, 4 * CHARACTERS):
        for i, text in enumerate(some, start):
            for part, n in plain_parts(text, table):
                points.append(part)
                own.append(np.full(len(part), i))
                begins.append(np.arange(len(part)) < n)
                size += n
                if size >= CHARACTERS:
                    yield joined()
                    points, own, begins, size = [], [], [], 0
    if points:
        yield joined()


@dataclass(frozen=True)
class Model:
    languages: list[str]
    shares: np.ndarray  # buckets x languages: logarithms
    first: np.ndarray  # logarithms of the languages' shares of the texts
    table: np.ndarray


def bucket_number(languages: int) -> int:
    """The largest power of two with ``CELLS`` cells at most for so many languages."""
    return 1 << max(6, min(MOST_BUCKETS.bit_length(), (CELLS // max(1, languages)).bit_length()) - 1)


def learned(rows: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    """The model of all ``rows`` that have a text and a language; None if there are none.

    What reaches the driver are counts per bucket and language, ``CELLS`` at most.
    """
    rows = rows.select(column(text).cast("string").alias("text"), column(lang).cast("string").alias("lang")).dropna()
    spark = rows.sparkSession
    table = spark.sparkContext.broadcast(letters())
    buckets = bucket_number(rows.select("lang").distinct().count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for batch in batches:
            coded = batch.column("lang").dictionary_encode()
            names, label = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            known = np.zeros(batch.num_rows, bool)
            for letter in letter_runs(batch.column("text"), table.value):
                found, of = letter.n_grams(buckets)
                known[of] = True
                for i in np.unique(label[of]):
                    add = np.bincount(found[label[of] == i], minlength=buckets)
                    total[names[i]] = total[names[i]] + add if names[i] in total else add
            for i, n in enumerate(np.bincount(label[known], minlength=len(names))):
                texts[names[i]] = texts.get(names[i], 0) + int(n)
        for name, counts in total.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(name, len(some) + 1), pa.array(np.append(some, -1)), pa.array(np.append(counts[some], texts[name]))],
                ["lang", "bucket", "n"],
            )

    sums = rows.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    if not sums.num_rows:
        return None
    names = sums["lang"].to_pylist()
    languages = sorted(set(names))
    place = {name: i for i, name in enumerate(languages)}
    of = np.array([place[n] for n in names])
    bucket, n = sums["bucket"].to_numpy(), sums["n"].to_numpy()
    counts, first = np.zeros((buckets, len(languages))), np.zeros(len(languages))
    first[of[bucket < 0]] = n[bucket < 0]
    counts[bucket[bucket >= 0], of[bucket >= 0]] = n[bucket >= 0]
    shares = np.log((counts + SMOOTHING) / (counts + SMOOTHING).sum(axis=0))
    return Model(languages, shares.astype(np.float32), np.log(first / first.sum()), table.value)


def predicted(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``row`` (all columns), the language ``lang_pred`` of every text and its ``score``."""
    rows = docs.select(packed(docs), column(text).cast("string").alias("text"))
    if model is None:
        return rows.select("row", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.languages, UNKNOWN], object)
        for batch in batches:
            total = np.zeros((batch.num_rows, len(m.languages)))
            known = np.zeros(batch.num_rows, bool)
            for letter in letter_runs(batch.column("text"), m.table):
                found, of = letter.n_grams(len(m.shares))
                known[of] = True
                for k in range(len(m.languages)):
                    total[:, k] += np.bincount(of, weights=m.shares[found, k], minlength=len(total))
            total += m.first
            best = np.argmax(total, axis=1)
            score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(names[np.where(known, best, -1)], pa.string()), pa.array(np.where(known, score, 0.0))],
                ["row", "lang_pred", "score"],
            )

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, lang_pred string, score double")


def held_out(ident: Column) -> Column:
    """Rows that are never learned from: those whose id, written out, has a CRC-32 of 2 modulo 4; a null id has none."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 4 == 2, F.lit(False))
