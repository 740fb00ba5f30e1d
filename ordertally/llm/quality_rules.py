"""Quality rules: plain counts and the divergence from language references.

Base rules drop texts with fewer than ``MIN_WORDS`` words, or whose words lie
mostly in eight-word windows that the text repeats.  Of the rest, a text with
enough words is compared with the reference of its language: its histograms
of character classes and of common words must be near the mean histograms of
that language (Jensen-Shannon distance, 0 to 1).  A text's language is the
one whose common words it has most of; the references are means over all
documents that pass the base rules.

Everything runs as DataFrame expressions: one pass over the texts writes a
narrow table of counts, from which references and verdicts follow.

Defined cases: null and empty texts have no words and fail the base rules; a
text of fewer than ``GUARD_WORDS`` words is judged by the base rules alone,
as is one whose language has no reference; a text without any common word is
compared by character classes with the mean over all languages; repeated
rows are judged each; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertally.llm.common import staged

MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
GUARD_WORDS = 40
# Largest distances of a kept text from its language's reference.
CLASS_DISTANCE = 0.30
WORD_DISTANCE = 0.35

# Very common words of the languages, most common first.
COMMON_WORDS = {
    "en": "the of and to in a is that it for was on".split(),
    "fr": "de la le et les des en un du une que est".split(),
    "de": "der die und in den von zu das mit sich des auf".split(),
    "es": "de la que el en y a los se del las un".split(),
}
_SPACE = r"[\x20\x09-\x0D]+"
# Counted character classes; white space, non-ASCII characters and the rest follow.
_COUNTED = {"upper": "[A-Z]", "digit": "[0-9]", "symbol": "[#*$%&|<>]", "mark": "[.,;:!?]", "other_mark": r"[\"'()\[\]{}/\\_^~`@=+-]"}


def _let(value: Column, fn) -> Column:
    """``fn`` of a value that is evaluated once."""
    return F.transform(F.array(value), fn)[0]


def _one_of(words: list[str]):
    return lambda w: w.isin(words)


def repeated_window_words(hashes: Column, windows: Column) -> Column:
    """Words in windows found twice or more, from the hashes of all windows in order."""

    def marked(order: Column) -> Column:
        same = lambda x, i, j: F.coalesce(x["h"] == F.get(order, j)["h"], F.lit(False))
        found = F.filter(order, lambda x, i: same(x, i, i - 1) | same(x, i, i + 1))
        return F.sort_array(F.transform(found, lambda x: x["at"]))

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda x, i: F.when(i == 0, WINDOW).otherwise(F.least(F.lit(WINDOW), x - F.get(at, i - 1))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    repeats = _let(_let(ordered, marked), covered)
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(repeats)


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of the base rules, the language and the two histograms of every document."""
    every = sorted({w for words in COMMON_WORDS.values() for w in words})
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select(
        "doc_id",
        "text",
        F.filter(F.split("text", _SPACE), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        *[F.regexp_count("text", F.lit(p)).cast("double").alias(f"c_{n}") for n, p in _COUNTED.items()],
    )
    rows = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.col("c_symbol").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.length("text").alias("chars"),
        F.regexp_count("text", F.lit(r"[^\x00-\x7F]")).cast("double").alias("c_wide"),
        *[f"c_{n}" for n in _COUNTED],
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
        F.filter(
            F.transform("words", lambda w: F.btrim(F.lower(w), F.lit(".,;:!?"))), lambda w: w.isin(every)
        ).alias("common"),
    )
    window = F.when(
        F.size("hashes") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("hashes") - WINDOW),
            lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    hits = [F.size(F.filter("common", _one_of(words))) for words in COMMON_WORDS.values()]
    classes = [f"c_{n}" for n in (*_COUNTED, "wide", "space", "rest")]
    rows = rows.withColumns({"windows": window, "hits": F.array(*hits), "c_space": (F.col("chars") - F.col("word_chars")).cast("double")})
    rows = rows.withColumn(
        "c_rest", F.greatest(F.lit(0.0), F.col("chars") - F.col("c_space") - sum(F.col(f"c_{n}") for n in (*_COUNTED, "wide")))
    ).withColumn("best", F.array_max("hits"))
    language = F.when(F.col("best") > 0, F.array_position("hits", F.col("best")).cast("int")).otherwise(F.lit(0))
    lists = F.array(*[F.array(*map(F.lit, ws)) for ws in COMMON_WORDS.values()])
    rows = rows.withColumn("language", language).withColumn("bins", F.get(lists, F.col("language") - 1))
    counted = F.transform("bins", lambda b: F.size(F.filter("common", lambda w: w == b)).cast("double"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        repeated_window_words(F.col("hashes"), F.col("windows")).alias("n_repeat_words"),
        "language",
        F.array(*classes).alias("class_counts"),
        F.when(
            F.col("language") > 0, F.concat(counted, F.array((F.col("n_words") - F.get("hits", F.col("language") - 1)).cast("double")))
        ).alias("word_counts"),
    )


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return _let(total, lambda t: F.transform(counts, lambda x: F.when(t > 0, x / t).otherwise(F.lit(0.0))))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two distributions, 0 to 1."""
    part = lambda x, y: F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))
    both = F.zip_with(p, q, lambda x, y: (part(x, y) + part(y, x)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(both, F.lit(0.0), lambda a, x: a + x)))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def language_references(table: DataFrame) -> DataFrame:
    """(language, class_ref, word_ref): mean histograms over documents that pass the base rules; 0: over all.

    At most one row per language.  Sums are of whole millionths, so they do
    not depend on the order of the rows.
    """
    n_classes, n_bins = len(_COUNTED) + 3, len(next(iter(COMMON_WORDS.values()))) + 1
    rows = table.filter(~base_failed() & (F.col("n_words") >= GUARD_WORDS)).select(
        F.explode(F.array(F.lit(0), F.col("language"))).alias("language"),
        _shares(F.col("class_counts")).alias("c"),
        _shares(F.col("word_counts")).alias("w"),
    )
    whole = lambda x: F.round(x * 1_000_000).cast("long")
    sums = rows.groupBy("language").agg(
        *[F.sum(whole(F.get("c", F.lit(i)))).alias(f"c{i}") for i in range(n_classes)],
        *[F.sum(whole(F.get("w", F.lit(i)))).alias(f"w{i}") for i in range(n_bins)],
    )
    as_doubles = lambda p, n: F.array(*[F.coalesce(F.col(f"{p}{i}"), F.lit(0)).cast("double") for i in range(n)])
    return sums.select(
        "language", _shares(as_doubles("c", n_classes)).alias("class_ref"), _shares(as_doubles("w", n_bins)).alias("word_ref")
    )


def judge(table: DataFrame) -> DataFrame:
    """Rows of ``text_counts`` with the two distances, ``base_failed`` and ``kept``."""
    references = F.broadcast(language_references(table))  # a row per language
    rows = table.join(references, "language", "left").withColumns(
        {
            "class_distance": js_distance(_shares(F.col("class_counts")), F.col("class_ref")),
            "word_distance": F.when(F.col("language") > 0, js_distance(_shares(F.col("word_counts")), F.col("word_ref"))),
            "base_failed": base_failed(),
        }
    )
    far = (F.col("class_distance") > CLASS_DISTANCE) | (F.coalesce("word_distance", F.lit(0.0)) > WORD_DISTANCE)
    guarded = F.col("n_words") < GUARD_WORDS
    return rows.withColumn("kept", ~F.col("base_failed") & (guarded | ~F.coalesce(far, F.lit(False))))


def op6(docs: DataFrame) -> DataFrame:
    table = staged(docs.sparkSession, text_counts(docs), "text-counts")
    return judge(table).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "class_distance", "word_distance",
    )
