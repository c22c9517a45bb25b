"""Quality rules whose cutoffs follow the corpus, from mergeable quantile sketches.

A sketch is a histogram with buckets of bounded relative width (1/64) over whole numbers:
one row per bucket with a count. Two sketches merge by adding counts, so each task builds
its own and the shuffle adds them up; a hot language or source is a few hundred rows per
task by then. Sketches exist per language and source. The quantiles of a source are mixed with those of the merged
sketches of its language, which weigh as much as ``PRIOR`` documents. So every source counts by its
own size, and none changes its cutoffs at once by growing.

All cutoffs are quantiles, or multiples of their distances; no fixed value stands in one. Shares are mostly
zero: beyond the 99th percentile and the fence of the quartiles they fail. Mean word length
fails where it lies as far outside the middle four fifths of the texts as these are wide, the number of words
only below. Symbols fail earlier, beyond the fence of the median and the
90th percentile, if the words are also longer or shorter than in four fifths of the texts, so that a single sign in
ordinary words is no reason.

Only DataFrame functions are used. Nulls: a null text has no words, a null language or
source is a group of its own. Texts of any length are measured whole. Equal rows are
judged alike. An empty table gives an empty result. Further columns pass through
whatever their names are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import packed, small_join, stored, word_array

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20

# The adaptive rules: shares and mean word length in thousandths, and the number of words.
SHARES = {
    "symbols": ("n_symbols", "n_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeat_words": ("n_repeat_words", "n_words"),
}
METRICS = [*SHARES, "word_length", "n_words"]
LEVELS = (10, 25, 50, 75, 90, 99)
SPREAD = 3
PRIOR = 500


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (all columns of the documents), the features and the metrics of each text."""
    rows = docs.select(packed(docs))
    t = F.coalesce(F.col(f"row.`{text}`"), F.lit(""))
    symbols = F.length(t) - F.length(F.translate(t, SYMBOLS, ""))
    rows = rows.withColumns(
        {
            "lines": F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
            "n_symbols": F.when(t.rlike(r"[#*$%&|<>]"), symbols).otherwise(0).cast("long"),
            "n_chars": F.length(t).cast("long"),
        }
    )
    rows = rows.withColumns(
        {
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        }
    )
    rows = _with_words(rows, t).drop("lines")
    # As in keep_good: no filter and no metric works out the features again.
    rows = rows.select(F.explode(F.array(F.struct("*"))).alias("all")).select("all.*")
    return rows.withColumns({m: _thousandths(*parts) for m, parts in {**SHARES, "word_length": ("word_chars", "n_words")}.items()})


def _thousandths(part: str, whole: str) -> Column:
    return F.expr(f"case when {whole} > 0 then {part} * 1000 div {whole} else 0L end")


def _with_words(rows: DataFrame, t: Column) -> DataFrame:
    """``n_words``, ``word_chars``, and ``n_repeat_words``: words inside windows of five words
    that occur twice or more in the text.

    Most texts repeat no window and are done after one look for equal hashes. In the others
    the hashes are sorted with their places, so that the time is near linear for any text.
    """
    rows = rows.withColumn("words", word_array(t))
    rows = rows.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "codes": F.expr("transform(words, w -> xxhash64(w))"),
        }
    )
    # The last windows run out of the text and are cut off.
    hashes = F.expr(
        f"""slice(transform(codes, (c, i) -> xxhash64(c, {', '.join(f'get(codes, i + {k})' for k in range(1, WINDOW))})),
                  1, greatest(size(codes) - {WINDOW - 1}, 0))"""
    )
    placed = F.expr(
        """case when size(array_distinct(hashes)) < size(hashes)
                then sort_array(transform(hashes, (h, i) -> struct(h, i))) end"""
    )
    repeated = F.expr(
        """case when placed is not null then sort_array(transform(
             filter(transform(placed, (x, i) -> struct(x.i as place,
                      (i > 0 and get(placed, i - 1).h = x.h) or coalesce(get(placed, i + 1).h = x.h, false) as twice)),
                    x -> x.twice),
             x -> x.place)) end"""
    )
    covered = F.expr(
        f"""case when repeated is null then 0L else
             aggregate(sequence(0, size(repeated) - 1), cast(0 as bigint),
               (n, k) -> n + least({WINDOW}, coalesce(get(repeated, k + 1) - get(repeated, k), {WINDOW}))) end"""
    )
    rows = rows.withColumn("hashes", hashes).withColumn("placed", placed).withColumn("repeated", repeated)
    return rows.withColumn("n_repeat_words", covered).drop("hashes", "placed", "repeated", "words", "codes")


def bucket(value: Column) -> Column:
    """Bucket of a whole number from 0: itself under 128, then 64 buckets for each doubling."""
    width = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    return (width * 64 + F.call_function("shiftright", value, width)).cast("long")


def bucket_floor(number: Column) -> Column:
    """The least value in a bucket."""
    doublings = F.greatest((number / 64).cast("int") - 1, F.lit(0))
    return F.when(number < 128, number).otherwise(
        F.call_function("shiftleft", (number % 64 + 64).cast("long"), doublings)
    )


def sketches(features: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per language, source, metric and bucket, with the number ``n`` of documents."""
    metrics = F.array(*[F.struct(F.lit(m).alias("metric"), bucket(F.col(m)).alias("bucket")) for m in METRICS])
    return (
        features.select(_key(lang).alias("lang_key"), _key(source).alias("source_key"), F.explode(metrics).alias("m"))
        .groupBy("lang_key", "source_key", "m.metric", "m.bucket")
        .agg(F.count("*").alias("n"))
    )


def _key(name: str) -> Column:
    value = F.col(f"row.`{name}`").cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), value))


def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Merge sketches and give the quantiles of each metric: ``total`` documents, ``q10`` to ``q99``."""
    per_bucket = parts.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "metric")
    counted = per_bucket.withColumns(
        {"total": F.sum("n").over(group), "upto": F.sum("n").over(group.orderBy("bucket"))}
    )
    quantile = lambda k: F.min(F.when(F.col("upto") * 100 >= F.col("total") * k, bucket_floor(F.col("bucket"))))
    return counted.groupBy(*keys, "metric").agg(
        F.max("total").alias("total"), *[quantile(k).alias(f"q{k}") for k in LEVELS]
    )


def fences(quantiles: DataFrame, keys: list[str]) -> DataFrame:
    """``least_<metric>`` and ``most_<metric>`` of each group, and what is usual: ``usual_symbols``,
    ``low_word_length``, ``high_word_length``. Ranges of lengths are ratios."""
    q = {k: F.col(f"q{k}") for k in LEVELS}
    low, high = F.greatest(q[10], F.lit(1)), F.greatest(q[90], F.lit(1))
    found = {f"most_{m}": (m, F.greatest(q[99], q[75] + SPREAD * (q[75] - q[25]))) for m in SHARES}
    found |= {
        "usual_symbols": ("symbols", q[90] + SPREAD * (q[90] - q[50])),
        "low_word_length": ("word_length", low),
        "high_word_length": ("word_length", high),
        "least_word_length": ("word_length", low * low / high),
        "most_word_length": ("word_length", high * high / low),
        "least_n_words": ("n_words", low * low / high),
    }
    return quantiles.groupBy(*keys).agg(
        *[F.max(F.when(F.col("metric") == m, fence)).cast("double").alias(name) for name, (m, fence) in found.items()]
    )


def cutoffs(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Cutoffs per language and source: ``lang_key``, ``source_key`` and the columns of ``fences``."""
    parts = stored(sketches(with_features(docs, text), lang, source))
    own = merged(parts, ["lang_key", "source_key"])
    levels = [f"q{k}" for k in LEVELS]
    wide = merged(parts, ["lang_key"]).drop("total").withColumnsRenamed({q: f"wide_{q}" for q in levels})
    mixed = {q: F.expr(f"(total * {q} + {PRIOR} * wide_{q}) div (total + {PRIOR})") for q in levels}
    return fences(own.join(wide, ["lang_key", "metric"]).withColumns(mixed), ["lang_key", "source_key"])


def judged(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``row``, the features, ``base_failed`` and ``kept`` of every document.

    Kept are documents that pass the base rules and lie within all cutoffs of their group.
    """
    limits = stored(cutoffs(docs, text, lang, source))
    features = with_features(docs, text).withColumns({"lang_key": _key(lang), "source_key": _key(source)})
    rows = small_join(features, limits, ["lang_key", "source_key"], "left")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    odd_words = ~F.col("word_length").between(F.col("low_word_length"), F.col("high_word_length"))
    out = (F.col("symbols") > F.col("usual_symbols")) & odd_words
    for m in METRICS:
        if f"most_{m}" in limits.columns:
            # Where fewer than one text in a hundred has any, having some is no reason by itself.
            out = out | ((F.col(m) > F.col(f"most_{m}")) & ((F.col(f"most_{m}") > 0) | odd_words))
        if f"least_{m}" in limits.columns:
            out = out | (F.col(m) < F.col(f"least_{m}"))
    within = ~F.coalesce(out, F.lit(False))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & within)


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that are kept, with their own columns.

    An explode in place of a filter: the optimizer would push a filter down to the scan and work
    out all features again for each time one is named in it.
    """
    kept = F.when(F.col("kept"), F.array("row")).otherwise(F.slice(F.array("row"), 1, 0))
    return judged(docs, text, lang, source).select(F.explode(kept).alias("row")).select("row.*")
