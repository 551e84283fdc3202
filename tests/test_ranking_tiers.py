import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests import brute
from waterline.operators import tiers
from waterline.operators.ranking import number_rows, number_rows_by


def test_numbers_in_skewed_groups(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.7 else f"g{rng.randint(0, 5)}", float(rng.randint(0, 40)), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double, id int")
    order = [F.col("v").desc(), F.col("id").asc()]
    for groups in (7, None):
        got = {r.id: r.at for r in number_rows(df, order, "at", within=["g"], groups=groups).collect()}
        seen = {}
        for g, _, i in sorted(rows, key=lambda r: (-r[1], r[2])):
            seen[g] = seen.get(g, 0) + 1
            assert got[i] == seen[g]
    got = [r.at for r in number_rows(df, order, "at").orderBy(F.desc("v"), "id").collect()]
    assert got == list(range(1, 3001))


def test_a_hot_group_spreads_over_partitions(spark):
    df = spark.range(20_000).select(F.lit("one").alias("g"), F.col("id"))
    numbered = number_rows(df, [F.col("id").asc()], "at", within=["g"], groups=1)
    sizes = [r["count"] for r in numbered.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 10_000
    assert numbered.filter(F.col("at") != F.col("id") + 1).count() == 0


def test_numbering_nothing(spark):
    assert number_rows(spark.range(0), [F.col("id").asc()], "at").count() == 0


def ranked(spark, values):
    ordered = sorted(values, reverse=True)
    return ordered, spark.createDataFrame([(v, i) for i, v in enumerate(ordered, 1)], "war double, overall_rank int")


def cases():
    rng = random.Random(3)
    return {
        "three": [1.0, 2.0, 3.0],
        "four": [1.0, 2.0, 2.5, 3.0],
        "thirty": [float(i * i) for i in range(30)],
        "equal": [2.0] * 60,
        "outlier": [rng.gauss(0, 1) for _ in range(70)] + [1000.0],
        "pairs": [float(i // 3) for i in range(150)],
        "spread": [rng.gauss(0, 3) for _ in range(400)],
        "repeats": [float(rng.randint(0, 60)) / 4 for _ in range(500)],
    }


@pytest.mark.parametrize("name", list(cases()))
def test_tiers_match_the_plain_model(spark, name):
    ordered, df = ranked(spark, cases()[name])
    got = [r.tier for r in tiers.assign_tiers(df).orderBy("overall_rank").collect()]
    assert got == brute.tiers(ordered)
    assert got == sorted(got)


def test_centers_and_silhouettes(spark):
    rng = random.Random(5)
    values = [round(rng.gauss(0, 2), 2) for _ in range(300)]
    line = tiers.value_line(spark.createDataFrame([(v,) for v in values], "v double"), "v")
    starts = tiers.quantile_starts(line, len(values), range(2, 12))
    found = tiers.lloyd(line, starts)
    scores = tiers.silhouettes(line, found)
    for k in range(2, 12):
        centers, member = brute.kmeans(values, k)
        assert found[k] == pytest.approx(centers)
        assert scores[k] == pytest.approx(brute.silhouette(values, member))


@pytest.mark.parametrize("blocks", [1, 7, 40])
def test_rounds_read_blocks_and_not_the_line(spark, blocks):
    """With an index of few blocks the centers stay the same, and a round reads no more than a block for every new cut."""
    rng = random.Random(8)
    values = [round(rng.gauss(0, 2), 3) for _ in range(4000)] + [0.5, 1.5, 2.5] * 40
    df = spark.createDataFrame([(v,) for v in values], "v double")
    line = tiers.value_line(df, "v", blocks)
    index = tiers.LineIndex.of(line)
    assert 1 <= len(index.first) <= blocks and index.size.sum() == len(set(values))
    ks = range(3, 9)
    starts = tiers.quantile_starts(line, len(values), ks, index)
    found = tiers.lloyd(line, starts, index)
    for k in ks:
        centers, _ = brute.kmeans(values, k)
        assert found[k] == pytest.approx(centers, abs=1e-9)
    assert len(index.known) > 30
    assert 0 < index.rows_read <= len(index.known) * index.size.max()
    if blocks == 40:
        assert index.rows_read < len(index.known) * len(set(values)) / 20


def test_an_index_of_single_values_needs_no_further_read(spark):
    line = tiers.value_line(spark.range(500).selectExpr("double(id * id % 97) AS v"), "v")
    index = tiers.LineIndex.of(line)
    tiers.lloyd(line, tiers.quantile_starts(line, 500, range(2, 6), index), index)
    assert index.rows_read == 0 and len(index.first) == line.count()


def test_block_filters_reach_the_file_reader(spark):
    index = tiers.LineIndex.of(tiers.value_line(spark.range(3000).selectExpr("double(id) AS v"), "v", 100))
    some = index.rows_of({3, 4, 50, 98})
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan and "GreaterThanOrEqual(block,3),LessThanOrEqual(block,4)" in plan
    assert some.count() == 4 * 30


def test_many_scattered_blocks_make_few_conditions(spark):
    index = tiers.LineIndex.of(tiers.value_line(spark.range(4000).selectExpr("double(id) AS v"), "v", 2000))
    wanted = {b for b in range(0, 2000, 3)} | {1, 400}
    some = index.rows_of(wanted)
    assert some._jdf.queryExecution().optimizedPlan().toString().count(">=") <= 2 * tiers.MOST_RANGES
    assert sorted(r.value for r in some.collect()) == [float(v) for b in sorted(wanted) for v in (2 * b, 2 * b + 1)]
    starts = tiers.quantile_starts(index.line, 4000, range(30, 33), index)
    assert starts[31].tolist() == [float(int((i + 0.5) / 31 * 4000)) for i in range(31)]


def test_tiers_do_not_depend_on_the_layout(spark):
    rng = random.Random(12)
    rows = [(rng.gauss(0, 1) / 3, i) for i in range(900)]
    order = {i: n for n, (_, i) in enumerate(sorted(rows, reverse=True), 1)}
    df = spark.createDataFrame([(v, order[i], i) for v, i in rows], "war double, overall_rank int, i int")
    one, many = (tiers.assign_tiers(df.repartition(n, "i")).select("i", "tier").collect() for n in (1, 13))
    assert sorted(one) == sorted(many)


def test_values_that_are_no_numbers_are_in_no_cluster(spark):
    rows = [(float(v), r) for r, v in enumerate(range(80, 0, -1), 1)] + [(float("nan"), 81), (float("inf"), 82), (None, 83)]
    got = {r.overall_rank: r.tier for r in tiers.assign_tiers(spark.createDataFrame(rows, "war double, overall_rank int")).collect()}
    assert [got[r] for r in range(1, 81)] == brute.tiers([float(v) for v in range(80, 0, -1)])
    assert len(got) == 83 and None not in got.values()


def test_two_numbers_from_one_layout(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), float(rng.randint(0, 50)), i) for i in range(2500)]
    df = spark.createDataFrame(rows, "g string, v double, id int")
    order = [F.col("v").desc(), F.col("id").asc()]
    numbered = number_rows_by(df, order, {"place": "g", "at": None}, groups=4)
    got = {r.id: (r.place, r.at) for r in numbered.collect()}
    seen = {}
    for at, (g, _, i) in enumerate(sorted(rows, key=lambda r: (-r[1], r[2])), 1):
        seen[g] = seen.get(g, 0) + 1
        assert got[i] == (seen[g], at)
    # The rows themselves are not moved again: what is exchanged are the small tables of counts.
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "Repartition" not in plan and "Sort" not in plan
    assert number_rows_by(df.limit(0), order, {"place": "g", "at": None}, groups=4).count() == 0


def test_value_line_counts(spark):
    values = [1.0, 5.0, 5.0, 2.0, 9.0, 9.0, 9.0]
    line = tiers.value_line(spark.createDataFrame([(v,) for v in values], "v double"), "v").orderBy("value").collect()
    assert [(r.value, r.n, r.n_below, r.sum_below) for r in line] == [
        (1.0, 1, 0, 0.0), (2.0, 1, 1, 1.0), (5.0, 2, 2, 3.0), (9.0, 3, 4, 13.0),
    ]


def test_assignment_breaks_ties_by_index():
    values = np.array([0.0, 1.0, 2.0, 3.0, 4.0])
    for centers in ([1.0, 3.0], [3.0, 1.0], [2.0, 2.0], [4.0, 0.0, 4.0]):
        at = np.array(centers)
        slow = [min(range(len(at)), key=lambda i: (abs(v - at[i]), i)) for v in values]
        assert tiers._assign(values, at).tolist() == slow


def test_balanced_tiers_are_not_ntile(spark):
    df = spark.range(1, 11).select(F.col("id").cast("int").alias("r"))
    got = [r[0] for r in df.orderBy("r").select(tiers.balanced_tier(F.col("r"), 10, 4)).collect()]
    assert got == [1, 1, 1, 2, 2, 3, 3, 3, 4, 4]


def test_k_range():
    assert list(tiers.k_range(3)) == [] and list(tiers.k_range(4)) == [4]
    assert tiers.k_range(100) == range(30, 31) and tiers.k_range(10_000) == range(30, 49)


def test_best_rows_beyond_the_group_limit(spark):
    from waterline.operators.ranking import best_rows

    df = spark.range(6000).selectExpr("id", "id % 2 AS g", "id * 7919 % 6000 AS v")
    got = best_rows(df, [F.col("v").desc(), F.col("id").asc()], 2500, ["g"], "at")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window [row_number" not in plan and got.count() == 5000
    top = got.filter("g = 1 AND at <= 3").orderBy("at").collect()
    want = sorted((r for r in df.filter("g = 1").collect()), key=lambda r: -r.v)[:3]
    assert [r.id for r in top] == [r.id for r in want]
