"""Document quality: rules on the text, then a likelihood ratio of hashed n-grams.

Words and pairs of words are hashed to a fixed number of buckets. Two multinomials over the
buckets are counted: one of a trusted target, one of the raw corpus, both over whole texts and
all documents. A document's score is the mean of ``log(p_target / p_raw)`` over its n-grams, so
length does not matter; it is kept when the score reaches a fixed threshold. No sampling.

The target's count of a bucket and the count that the raw corpus lets expect both get
``PSEUDO_COUNT`` more, so that a bucket with little evidence has a ratio near 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.expressions import let, long, text_length, words_of

BUCKETS = 1 << 14
THRESHOLD = -0.05
PSEUDO_COUNT = 20.0
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def repeated_words(words: Column, size: int = 3) -> Column:
    """Words in ``size``-word windows that are in the text twice or more, each counted once.

    ``words`` must be a variable or a column. Windows are sorted by hash with their places, so
    long texts take n log n steps.
    """

    def window(word: Column, i: Column) -> Column:
        return F.struct(F.xxhash64(word, *(F.get(words, i + k) for k in range(1, size))).alias("h"), i.alias("i"))

    def covered(windows: Column) -> Column:
        twice = F.filter(
            windows,
            lambda x, k: (F.get(windows, k - 1).h.eqNullSafe(x.h)) | (F.get(windows, k + 1).h.eqNullSafe(x.h)),
        )
        return let(
            F.sort_array(F.transform(twice, lambda x: x.i)),
            lambda at: F.aggregate(
                F.transform(at, lambda p, k: F.least(F.lit(size), F.coalesce(F.get(at, k + 1) - p, F.lit(size)))),
                long(0),
                lambda total, n: total + n,
            ),
        )

    count = F.size(words) - (size - 1)
    return F.when(count < 2, long(0)).otherwise(
        let(
            F.slice(F.transform(words, window), F.lit(1), F.greatest(count, F.lit(0))),
            lambda raw: F.when(
                F.size(F.array_distinct(F.transform(raw, lambda x: x.h))) == F.size(raw), long(0)
            ).otherwise(let(F.sort_array(raw), covered)),
        )
    )


def n_gram_buckets(words: Column, buckets: int) -> Column:
    """A bucket for each word, and one for each pair of neighbours; the last word's is the end."""

    def bucket(*parts: Column) -> Column:
        return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")

    return F.concat(
        F.transform(words, lambda w: bucket(w)),
        F.transform(words, lambda w, i: bucket(w, F.coalesce(F.get(words, i + 1), F.lit("\n")))),
    )


def log_ratios(texts: DataFrame, trusted: Column, buckets: int = BUCKETS) -> DataFrame:
    """One row: ``ratios``, the log ratio of target and raw frequency of each bucket."""
    grams = texts.select(
        trusted.alias("trusted"),
        F.explode(let(words_of(F.col("text")), lambda w: n_gram_buckets(w, buckets))).alias("bucket"),
    )
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count_if("trusted").alias("target"))
    every = texts.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    filled = every.join(counts, "bucket", "left").select(
        "bucket", F.coalesce("raw", long(0)).alias("raw"), F.coalesce("target", long(0)).alias("target")
    )
    listed = filled.agg(
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("all"),
        F.sum("raw").alias("raw"),
        F.sum("target").alias("target"),
    )
    # The target's share of the corpus: what it would count if it were like the rest.
    share = F.coalesce(F.col("target") / F.col("raw"), F.lit(0.0))
    return listed.select(
        F.transform(
            "all", lambda b: F.log((b.target + PSEUDO_COUNT) / (b.raw * share + PSEUDO_COUNT))
        ).alias("ratios")
    )


def quality(
    docs: DataFrame,
    trusted_ids: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    trusted_column: str = "doc_id",
    buckets: int = BUCKETS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``docs``: the rule measures, ``score`` and ``kept``.

    ``trusted_ids`` names the documents of the trusted target, repeated or unknown ids do no
    harm. Returns ``id_column, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, score, kept``. A null or empty text has no words: it fails the rules and has
    a null score. With no trusted document all ratios are near 0. Rows without an id or with a
    repeated id are judged like others. Extra columns are not read.
    """
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    trusted = trusted_ids.select(F.col(trusted_column).alias("id"), F.lit(True).alias("trusted"))
    flagged = texts.join(trusted.where("id is not null").distinct().hint("shuffle_hash"), "id", "left")
    # Spark runs this one row first and hands it to the tasks as a value.
    ratios = log_ratios(flagged, F.col("trusted").isNotNull(), buckets).scalar()
    text = F.coalesce("text", F.lit(""))

    def measure(words: Column) -> Column:
        grams = n_gram_buckets(words, buckets)
        total = let(
            F.col("ratios"),
            lambda table: F.aggregate(grams, F.lit(0.0), lambda s, b: s + F.get(table, b)),
        )
        n = F.size(words)
        return F.struct(
            n.cast("long").alias("n_words"),
            repeated_words(words).alias("n_repeat_words"),
            F.when(n > 0, total / (2 * n)).alias("score"),
        )

    lines = F.filter(F.split(text, "\n"), lambda x: F.length(_without(x, _SPACES)) > 0)
    measured = texts.withColumn("ratios", ratios).select(
        "id",
        text_length(_without(text, _SPACES)).alias("word_chars"),
        (text_length(text) - text_length(_without(text, SYMBOLS))).alias("n_symbols"),
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        let(words_of(text), measure).alias("m"),
    )
    failed = (F.col("m.n_words") < MIN_WORDS) | (100 * F.col("m.n_repeat_words") > 50 * F.col("m.n_words"))
    return measured.select(
        F.col("id").alias(id_column),
        "m.n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "m.n_repeat_words",
        failed.alias("base_failed"),
        F.round("m.score", 6).alias("score"),
        (~failed & F.coalesce(F.col("m.score") >= threshold, F.lit(False))).alias("kept"),
    )
