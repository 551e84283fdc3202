import math
import os
import tempfile

import pytest
from helpers import awkward, frame, near_groups, prose, quality_counts, row

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from waterline.llm.queries import ORACLE, REGISTRY

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))
    assert set(REGISTRY) | {"pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = REGISTRY[name](spark, SF)
    cursor = con.execute(ORACLE[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(found.columns)
    key = lambda rows, own: sorted(repr([r[own.index(c)] for c in sorted(names)]) for r in rows)
    got, want = key(found.collect(), found.columns), key(cursor.fetchall(), names)
    assert got == want and (got or name.startswith("op3"))


@needs_data
@pytest.mark.parametrize("name", sorted(set(REGISTRY) - set(ORACLE)))
def test_query_covers_its_table(spark, name):
    rows = REGISTRY[name](spark, SF).collect()
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(rows) == n or name.startswith(("op2", "op8"))
    assert all(isinstance(r.doc_id, int) for r in rows)


def write(df, path):
    df.coalesce(1).write.parquet(path)


def stage_results(spark, docs, bench, labels):
    top = tempfile.mkdtemp(prefix="pipeline-")
    write(bench, f"{top}/benchmark.parquet")
    write(labels, f"{top}/labels.parquet")
    results = []
    for name, stage in corpus_pipeline.STAGES:
        path = f"{top}/{len(results)}"
        stage(spark, docs, top).write.parquet(path)
        docs = spark.read.parquet(path)
        results.append((name, docs))
    return results


def test_stages_do_what_brute_force_does(spark):
    items = [(k, " ".join(prose(800 + k, 14)) + ". " + " ".join(prose(850 + k, 16)) + ".") for k in range(4)]
    rows = [row(k, " ".join(prose(k, 60))) for k in range(60)]
    rows += [row(100 + k, " ".join(prose(k, 60)[:-1] + ["end"])) for k in range(8)] + [row(200, " ".join(prose(3, 60)).upper())]
    rows += [row(300 + k, " ".join(prose(900 + k, 30)) + " " + items[k][1]) for k in range(4)]
    rows += [row(400, "short"), row(401, " ".join(["again and again we say"] * 9)), row(402, None), row(20, rows[20][1])]
    bench = frame(spark, items, "item_id long, text string")
    labels = frame(spark, [(k, 1, 0) for k in range(60)], "doc_id long, quality int, toxic int")
    results = dict(stage_results(spark, frame(spark, rows), bench, labels))
    after = [sorted(r.doc_id for r in df.collect()) for df in results.values()]
    good = [r for r in rows if not (lambda c: c[0] < 10 or 100 * c[4] > 20 * c[0])(quality_counts(r[1]))]
    assert after[0] == sorted(r[0] for r in good)
    leaders = near_groups([(r[0], r[1]) for r in good])
    assert after[1] == sorted(i for i, c in leaders.items() if i == c)
    assert after[2] == [i for i in after[1] if not 300 <= i < 304]
    assert set(after[3]) == set(after[2]) and after[4] == after[3]
    assert all(df.columns == ["doc_id", "text", "lang", "source", "n_chars"] for df in list(results.values())[:-1])
    last = results["sharding"].collect()
    sums = [sum(r.size for r in last if r.shard == k) for k in range(corpus_pipeline.SHARDS)]
    assert max(sums) - min(sums) <= 2 * max(r.size for r in last)


def test_awkward_and_empty_input(spark):
    bench = frame(spark, [(1, None)], "item_id long, text string")
    labels = frame(spark, [(None, None, None)], "doc_id long, quality int, toxic int")
    assert [df.count() for _, df in stage_results(spark, frame(spark, []), bench, labels)] == [0] * 5
    kept = [df.count() for _, df in stage_results(spark, awkward(spark), bench, labels)]
    # The long text, three of 40 to 60 words and their repeats pass; the repeated row and its copy go.
    assert kept[:3] == [6, 4, 4] and kept[3] == kept[4]


@needs_data
def test_run_gives_what_the_stages_give(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tempfile.mkdtemp(prefix='pipeline-')}/{k}"
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
    columns = ["doc_id", "shard", "slot", "size"]
    want = sorted(map(tuple, docs.select(*columns).collect()))
    assert want == sorted(map(tuple, corpus_pipeline.run(spark, SF).select(*columns).collect()))
    assert not any(math.isnan(r[3]) for r in want)


def test_rows_of_shared_and_missing_ids_are_compared(spark):
    near = lambda k: " ".join(prose(k, 60)[:-1] + ["end"])
    rows = [row(None, " ".join(prose(k, 60))) for k in (1, 1, 2)] + [row(None, near(2)), row(None, None), row(7, " ".join(prose(1, 60)))]
    rows += [row(9, " ".join(prose(k, 60))) for k in (3, 4, 4)] + [row(12, near(4))]
    stage = dict(corpus_pipeline.STAGES)["near-duplicate removal"]
    found = stage(spark, frame(spark, rows), "").collect()
    topics = [[k for k in (1, 2, 3, 4) if r.text and set(prose(k, 60)[:20]) <= set(r.text.split())] for r in found]
    # A text of each topic stays, and the row without a text; the copy without an id goes for that of an id.
    assert sorted(t for t in topics if t) == [[1], [2], [3], [4]] and len(found) == 5
    assert [r.doc_id for r, t in zip(found, topics, strict=True) if t == [1]] == [7]
