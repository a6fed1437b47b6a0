"""Quality rules: per-document measures and line frequency across a host's documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.carrying import carrying

SPACE = "[\\x20\\x09-\\x0D]+"
_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 5
ADDED = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_common_lines n_words_left"
    " base_failed kept"
).split()


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def has_word(text: Column) -> Column:
    return F.translate(text, _SPACES, "") != ""


def normalised(line: Column) -> Column:
    """A-Z as a-z, white space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.translate(line, _UPPER, _LOWER), SPACE, " "))


def repeated_words(words: Column) -> Column:
    """How many words lie in 5-word windows that occur twice or more in `words`."""

    def windows(w: Column) -> Column:
        last = F.size(w) - WINDOW
        at = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0))))
        return F.transform(
            F.coalesce(at, F.array().cast("array<int>")),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]),
        )

    def twice(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(
            ranked,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(
                        s,
                        lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                        | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)),
                    ),
                    lambda x: x["i"],
                )
            ),
        )

    def covered(at: Column) -> Column:
        step = F.transform(
            at,
            lambda p, i: F.least(
                F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))
            ),
        )
        return F.aggregate(step, F.lit(0).cast("bigint"), lambda a, x: a + x)

    return let(
        let(words, windows),
        lambda h: F.when(
            F.size(F.array_distinct(h)) < F.size(h), let(twice(h), covered)
        ).otherwise(F.lit(0).cast("bigint")),
    )


def measures(text: Column) -> dict[str, Column]:
    """The base measures of one text; null has no words."""
    some = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(some, "\n"), has_word)
    words = split_words(some)
    return {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": F.length(F.translate(some, _SPACES, "")).cast("bigint"),
        "n_symbols": (F.length(some) - F.length(F.translate(some, _SYMBOLS, ""))).cast("bigint"),
        "n_dup_lines": let(
            lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")
        ),
        "n_repeat_words": repeated_words(words),
    }


def _host(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("h"), F.col(column).cast("string")), F.lit(""))


def common_lines(docs: DataFrame, host: str, share: float, at_least: int) -> DataFrame:
    """(host, doc_id, key, common): hashes of each document's lines that are too common.

    A line is too common on a host if more than `share` of the host's documents and
    more than `at_least` of them hold it.  Documents with equal text count as one.
    A document counts once per line however often it repeats it.
    """
    hashes = F.transform(
        F.filter(F.split("text", "\n"), has_word), lambda x: F.xxhash64(normalised(x))
    )
    # Hashed before exploding, so that the text is not copied and hashed for each line.
    whole = docs.select(
        _host(host).alias("host"),
        "doc_id",
        F.xxhash64("text").alias("key"),
        F.array_distinct(hashes).alias("lines"),
    )
    # An outer explode: a plain one lets Spark ask first whether there is any line, which hashes all
    # lines twice.
    lines = whole.select("host", "doc_id", "key", F.explode_outer("lines").alias("line"))
    lines = lines.filter("line is not null")
    counts = (
        lines.groupBy("host", "line")
        .agg(F.countDistinct("key").alias("n"))
        .filter(F.col("n") > at_least)
    )
    totals = docs.groupBy(_host(host).alias("host")).agg(
        F.countDistinct(F.coalesce(F.xxhash64("text"), F.lit(0))).alias("documents")
    )
    flagged = (
        counts.join(totals, "host")
        .filter(F.col("n") > share * F.col("documents"))
        .select("host", "line")
    )
    return (
        lines.join(flagged, ["host", "line"])
        .groupBy("host", "doc_id", "key")
        .agg(F.collect_set("line").alias("common"))
    )


@carrying(*ADDED, named=("host",))
def quality(
    docs: DataFrame,
    *,
    host: str = "source",
    common_share: float = 0.05,
    common_at_least: int = 10,
    least_words: int = 10,
    least_left: float = 0.3,
    most_repeated: int = 20,
) -> DataFrame:
    """`docs` with base measures, common lines taken out of `text`, and `kept`.

    base_failed: fewer than `least_words` words, or more than `most_repeated` percent of
    them in repeated 5-word windows.  Lines that are too common among a host's documents
    (see `common_lines`) are removed from the text.  A document is depleted, and so not kept,
    if lines were removed and fewer than `least_words` words or less than `least_left`
    of its words are left.  n_common_lines counts removed lines with repeats.

    A null text has no words and stays null; it fails the base rule.  A null host is a
    host of its own.  Rows that repeat a doc_id are judged each by its own text; equal
    rows get equal results.  Other columns pass through; existing columns of the added
    names are replaced.  Everything is built-in SQL functions.
    """
    base = docs.drop(*ADDED)
    found = common_lines(docs, host, common_share, common_at_least).alias("f")
    lines = F.split("text", "\n")
    sized = base.select(
        "*",
        *[c.alias(name) for name, c in measures(F.col("text")).items()],
        _host(host).alias("_host"),
        F.xxhash64("text").alias("_key"),
        F.transform(
            lines,
            lambda x: F.struct(
                F.when(has_word(x), F.xxhash64(normalised(x))).alias("h"),
                F.size(split_words(x)).alias("w"),
            ),
        ).alias("_lines"),
    ).alias("d")
    joined = sized.join(
        found,
        (F.col("d._host") == F.col("f.host"))
        & F.col("d.doc_id").eqNullSafe(F.col("f.doc_id"))
        & (F.col("d._key") == F.col("f.key")),
        "left",
    ).select("d.*", F.col("f.common").alias("_common"))

    def is_common(h: Column) -> Column:
        return F.coalesce(F.array_contains("_common", h), F.lit(False))

    removed = F.filter("_lines", lambda x: is_common(x["h"]))
    gone = joined.withColumn("_removed", F.when(F.col("_common").isNotNull(), removed))
    n_gone = F.aggregate("_removed", F.lit(0).cast("bigint"), lambda a, x: a + x["w"])
    counted = gone.withColumns(
        {
            "n_common_lines": F.coalesce(F.size("_removed"), F.lit(0)).cast("bigint"),
            "n_words_left": F.col("n_words") - F.coalesce(n_gone, F.lit(0)),
            "base_failed": (F.col("n_words") < least_words)
            | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words")),
        }
    )
    depleted = F.col("_common").isNotNull() & (
        (F.col("n_words_left") < least_words)
        | (F.col("n_words_left") < least_left * F.col("n_words"))
    )
    left = F.transform(
        F.filter(
            F.arrays_zip(F.split("text", "\n").alias("line"), F.col("_lines").alias("of")),
            lambda x: ~is_common(x["of"]["h"]),
        ),
        lambda x: x["line"],
    )
    text = F.when(F.col("_common").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return counted.select(
        *[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in base.columns],
        *ADDED[:-1],
        (~F.col("base_failed") & ~depleted).alias("kept"),
    )
