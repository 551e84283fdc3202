"""Quality rules whose thresholds follow each language and source.

Every document gets a few counts of its words, lines and symbols. Their rates are summarised for each (lang,
source) by a mergeable quantile sketch, and a document is rejected if a rate lies far beyond an upper quantile of its own
group, measured in that quantile's distance from the median. All of it is column expressions.

The sketch is a log-linear histogram: a rate is an integer (thousandths), values below 512 have a bucket each and every
doubling above has 256, so a quantile is off by at most 1/256 of itself. Counts of buckets add up, so sketches of parts
merge into those of the whole, of a language, or of the corpus, exactly and in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waterline.sources.storage import materialise, small

BLANK = r"[\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Rates in thousandths: (count, of which count), the upper quantile in per cent, how many times its distance from the median
#: is far, and the least distance that is, for groups with next to no spread; in ordinary groups the quantiles decide. Marks are
#: characters of words that are no letter, digit or combining mark. Lines and words are repeated in few documents of a group, so
#: their quantile is a high one.
RATES = {
    "marks": ("_marks", "word_chars", 90, 5, 20),
    "word_length": ("word_chars", "n_words", 90, 5, 500),
    "dup_lines": ("n_dup_lines", "_lines", 99, 3, 300),
    "repeats": ("n_repeat_words", "n_words", 99, 3, 100),
}
#: Rates of which small values are suspect as well, by the lower quantile that mirrors the upper one.
TWO_SIDED = ("word_length",)
#: Groups of fewer rows borrow the sketch of their language, and small languages that of the corpus.
LEAST_ROWS = 50
#: Leading binary digits of a value that its bucket keeps.
DIGITS = 9


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def repeat_words_sql(words: str, hashes: str) -> str:
    """Words inside windows that occur twice or more, from the array of window hashes.

    Only where the distinct windows are fewer than all are they sorted; the starts of repeated windows, in
    order, then each cover the words up to the next start, at most a window.
    """
    sized = f"sort_array(transform({hashes}, (h, i) -> struct(h AS h, i AS i)))"
    starts = (
        "sort_array(filter(transform(s, (x, k) -> CASE WHEN x.h = get(s, k - 1).h OR x.h = get(s, k + 1).h THEN x.i END), "
        "x -> x IS NOT NULL))"
    )
    covered = (
        f"aggregate(transform(p, (x, k) -> least({WINDOW}, coalesce(get(p, k + 1) - x, {WINDOW}))), 0L, (a, x) -> a + x)"
    )
    return (
        f"CASE WHEN size(array_distinct({hashes})) < size({hashes}) THEN {_let('s', sized, _let('p', starts, covered))} ELSE 0L END"
    )


def with_counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, _lines (lines with a word) and _marks."""
    body = documents.withColumns(
        {
            "_body": F.coalesce(F.col(text), F.lit("")),
            "_words": F.expr(f"array_remove(split(coalesce(`{text}`, ''), '{BLANK}+'), '')"),
            "_all_lines": F.expr(f"filter(split(coalesce(`{text}`, ''), '\\n'), l -> l RLIKE '[^\\\\x20\\\\x09-\\\\x0D]')"),
        }
    )
    hashed = ", ".join(f"_words[i + {k}]" for k in range(WINDOW))
    body = body.withColumns(
        {
            "n_words": F.expr("bigint(size(_words))"),
            "word_chars": F.expr("bigint(char_length(array_join(_words, '')))"),
            "_marks": F.expr(r"bigint(char_length(regexp_replace(array_join(_words, ''), '[\\p{L}\\p{N}\\p{M}]+', '')))"),
            "n_symbols": F.expr(f"bigint(octet_length(_body) - octet_length(regexp_replace(_body, '{SYMBOLS}+', '')))"),
            "_lines": F.expr("bigint(size(_all_lines))"),
            "n_dup_lines": F.expr("bigint(size(_all_lines) - size(array_distinct(_all_lines)))"),
            "_windows": F.expr(
                f"CASE WHEN size(_words) >= {WINDOW} THEN transform(sequence(0, size(_words) - {WINDOW}), i -> xxhash64({hashed})) "
                "ELSE array() END"
            ),
        }
    )
    return body.withColumn("n_repeat_words", F.expr(repeat_words_sql("_words", "_windows"))).drop(
        "_body", "_words", "_all_lines", "_windows"
    )


def bucket_sql(v: str) -> str:
    """The smallest value of the bucket of a non-negative integer."""
    return f"{v} - {v} % shiftleft(1L, greatest(0, length(bin({v})) - {DIGITS}))"


def sketches(counted: DataFrame, lang: str, source: str) -> DataFrame:
    """(lang, source, rate, bucket, n): the sketch of every group's rates, combined before the exchange."""
    entries = ", ".join(
        f"struct('{name}' AS rate, {a} * 1000 div greatest({b}, 1) AS v)" for name, (a, b, *_) in RATES.items()
    )
    values = counted.selectExpr(f"string(`{lang}`) AS lang", f"string(`{source}`) AS source", f"inline(array({entries}))")
    return values.groupBy("lang", "source", "rate", F.expr(bucket_sql("v")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """(lang, source, <rate>_low, <rate>_high) of every group, from its own or a merged sketch."""
    levels = sketch.selectExpr(
        "lang", "source", "rate", "bucket", "n", "inline(array(struct(0 AS level), struct(1 AS level), struct(2 AS level)))"
    )
    merged = levels.selectExpr(
        "level", "CASE WHEN level < 2 THEN lang END AS lang", "CASE WHEN level < 1 THEN source END AS source", "rate", "bucket", "n"
    ).groupBy("level", "lang", "source", "rate", "bucket").agg(F.sum("n").alias("n"))
    # A sketch has some thousand buckets at most, so a window over one is small whatever it counts.
    running = merged.selectExpr(
        "*",
        "sum(n) OVER (PARTITION BY level, lang, source, rate ORDER BY bucket) AS upto",
        "sum(n) OVER (PARTITION BY level, lang, source, rate) AS total",
    )
    wanted = sorted({50, *(q for _, _, q, _, _ in RATES.values()), *(100 - RATES[name][2] for name in TWO_SIDED)})
    quantiles = running.groupBy("level", "lang", "source", "rate").agg(
        *[F.expr(f"min(CASE WHEN upto * 100 >= total * {q} THEN bucket END) AS q{q}") for q in wanted], F.max("total").alias("total")
    )
    sides = []
    for name, (_, _, q, reach, least) in RATES.items():
        far = lambda gap: f"greatest({reach} * ({gap}), {least})"  # noqa: B023, E731
        low = f"q50 - {far(f'q50 - q{100 - q}')}" if name in TWO_SIDED else "-1L"
        sides += [
            F.expr(f"max(CASE WHEN rate = '{name}' THEN {low} END) AS {name}_low"),
            F.expr(f"max(CASE WHEN rate = '{name}' THEN q50 + {far(f'q{q} - q50')} END) AS {name}_high"),
        ]
    limits = quantiles.groupBy("level", "lang", "source").agg(*sides, F.max("total").alias("total"))
    names = [f"{name}_{side}" for name in RATES for side in ("low", "high")]
    # Every group looks at its own limits, its language's and the corpus's, and takes the first with enough rows.
    looked = limits.filter("level = 0").selectExpr(
        "lang AS _lang",
        "source AS _source",
        "inline(array(struct(0 AS level, lang AS lang, source AS source), "
        "struct(1 AS level, lang AS lang, string(NULL) AS source), "
        "struct(2 AS level, string(NULL) AS lang, string(NULL) AS source)))",
    )
    found = looked.alias("w").join(
        limits.alias("l"),
        F.expr("w.level = l.level AND w.lang <=> l.lang AND w.source <=> l.source"),
    )
    return (
        found.filter(f"l.total >= {LEAST_ROWS} OR l.level = 2")
        .groupBy("_lang", "_source")
        .agg(F.min_by(F.struct(*names), "l.level").alias("limits"))
        .select("_lang", "_source", "limits.*")
    )


def quality_rules(
    documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", keep_text: bool = True
) -> DataFrame:
    """All rows and columns of ``documents`` (without ``keep_text``: but the text) with the counts, base_failed and kept.

    base_failed: fewer than 10 words, or over a fifth of the words in five-word windows that repeat in the text. kept:
    not base_failed, and every rate within its group's limits. Sketches are made of the rows that did not fail, all of
    them. A null text counts as empty and fails. Null languages and sources are groups of
    their own. Repeated rows count, and are judged, each for itself. Columns of ``documents`` that have the
    name of a result are replaced. An empty table gives an empty result.
    """
    names = {*COUNTS, "base_failed", "kept", "_lines", "_marks", "_lang", "_source"}
    counted = with_counts(documents.drop(*names), text)
    counted = counted.withColumn("base_failed", F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words"))
    counted = materialise(counted if keep_text else counted.drop(text))
    limits = materialise(thresholds(sketches(counted.filter("NOT base_failed"), lang, source)))
    # Broadcast only when counted to be short; else the join is left to Spark, which splits a hot source.
    side = small(limits, limits.count())
    on = counted[lang].eqNullSafe(side["_lang"]) & counted[source].eqNullSafe(side["_source"])
    within = " AND ".join(
        f"({a} * 1000 div greatest({b}, 1)) BETWEEN {name}_low AND {name}_high" for name, (a, b, *_) in RATES.items()
    )
    judged = counted.join(side, on, "left").withColumn("kept", F.expr(f"NOT base_failed AND coalesce({within}, true)"))
    return judged.drop(*[f"{name}_{side}" for name in RATES for side in ("low", "high")], "_lang", "_source", "_lines", "_marks")
