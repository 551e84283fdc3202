"""How filters interact: what each removes, alone and in every order, counted over all documents.

Five filters are decided for every document, two of them from the rows of a sparse document-term matrix. What a document
fails is five bits, so all orders follow from one count of documents by those bits.

A: under 100 words. B: 100 * distinct words < 80 * words. C: 100 * `[A-Z]` characters > 10 * code points. D: holds any of
`#$%&*|`. E: its text is that of a smaller doc_id, anywhere in the table. Words are `[^\\x20\\x09-\\x0D]+`, case-sensitive.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waterline.llm.term_matrix import row_totals, term_matrix
from waterline.sources.storage import materialise

FILTERS = "ABCDE"
CONDITIONS = {
    "A": "n_words < 100",
    "B": "100 * n_distinct < 80 * n_words",
    "C": "100 * n_upper > 10 * n_chars",
    "D": "n_marks > 0",
}


def filter_failures(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, the columns ``keep``, A, B, C, D, E) of every row of ``documents``: whether it fails each filter.

    A null text counts as empty. Rows without an id count as larger than every id, and among themselves have no smaller one.
    Rows that share an id and a text are no copies of each other. Other columns are ignored; an empty table gives
    an empty result.
    """
    found = row_totals(term_matrix(documents, doc_id, text, keep).shards)
    decided = found.select("doc_id", *keep, "digest", *[F.expr(rule).alias(name) for name, rule in CONDITIONS.items()])
    decided = materialise(decided)
    # The one id of each text that stays: the join is by it and the text, so a text of many copies is no hot key.
    firsts = decided.groupBy("digest").agg(F.min("doc_id").alias("first")).withColumn("stays", F.lit(True))
    on = [decided["digest"] == firsts["digest"], decided["doc_id"].eqNullSafe(firsts["first"])]
    judged = decided.join(firsts, on, "left")
    return judged.select(decided["doc_id"], *[decided[c] for c in keep], *CONDITIONS, F.col("stays").isNull().alias("E"))


def outcome_counts(failures: DataFrame, labels: DataFrame, part: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """(part, fails, n, n_good, n_toxic): documents of each part by the set of filters they fail, the first filter's bit lowest.

    A row of ``failures`` is good or toxic if some row of ``labels`` for its id says so; a null id has no labels.
    """
    marked = labels.groupBy(F.col(doc_id).alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    bits = sum((F.col(name).cast("int") * (1 << k) for k, name in enumerate(FILTERS)), F.lit(0))
    rows = failures.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), bits.alias("fails"))
    return rows.join(marked, "doc_id", "left").groupBy("part", "fails").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("n_good"), F.count_if("toxic").alias("n_toxic")
    )


def order_steps() -> list[tuple[str, int, int, int]]:
    """(filter_order, step, bit of the step's filter, bits of those before it) of all orders."""
    return [
        ("".join(order), k + 1, 1 << FILTERS.index(order[k]), sum(1 << FILTERS.index(f) for f in order[:k]))
        for order in permutations(FILTERS)
        for k in range(len(FILTERS))
    ]


def audit(counts: DataFrame) -> DataFrame:
    """From ``outcome_counts`` a row for every part, order and step, with what the step's filter does there.

    kept, removed, redundant (failing it, but removed earlier), unique_fails (failing no other filter), good_lost and
    toxic_lost (of those removed here), and shapley (removed by this filter, summed over all orders).
    """
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "n_good", "n_toxic")).alias("sets"))  # 32 at most
    steps = ", ".join(f"struct('{o}' AS filter_order, {k} AS step, {own} AS own, {before} AS before)" for o, k, own, before in order_steps())
    rows = parts.select("part", "sets", F.expr(f"inline(array({steps}))"))

    def total(value: str, condition: str) -> str:
        return f"aggregate(sets, 0L, (a, s) -> a + CASE WHEN {condition} THEN s.{value} ELSE 0L END)"

    here = "(s.fails & own) != 0 AND (s.fails & before) = 0"
    reached = rows.selectExpr(
        "part",
        "filter_order",
        "step",
        "own",
        f"{total('n', '(s.fails & (own | before)) = 0')} AS kept",
        f"{total('n', here)} AS removed",
        f"{total('n', '(s.fails & own) != 0 AND (s.fails & before) != 0')} AS redundant",
        f"{total('n', 's.fails = own')} AS unique_fails",
        f"{total('n_good', here)} AS good_lost",
        f"{total('n_toxic', here)} AS toxic_lost",
    )
    return reached.withColumn("shapley", F.expr("sum(removed) OVER (PARTITION BY part, own)")).drop("own")


def filter_audit(
    documents: DataFrame, labels: DataFrame, part: str = "lang", doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): 600 rows a part.

    Parts are the values of the column ``part`` in ``documents``, null and the empty string being one. Nulls, repeats and empty
    tables are treated as ``filter_failures`` and ``outcome_counts`` say; an empty table has no parts.
    """
    named = documents.select(F.col(doc_id).alias("doc_id"), F.col(part).alias("part_of"), F.col(text).alias("text"))
    failures = filter_failures(named, keep=("part_of",))
    return audit(outcome_counts(failures, labels.withColumnRenamed(doc_id, "doc_id"), "part_of"))
