import os

import pytest
from helpers import awkward, frame, prose, quality_counts, row, with_clashes, words

from waterline.llm.quality_rules import COUNTS, LEAST_ROWS, RATES, TWO_SIDED, quality_rules, sketches, thresholds, with_counts
from waterline.sources.storage import materialise

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")


def test_counts_equal_brute_force(spark):
    texts = {
        1: "a b c d e f a b c d e g", 2: "x x x x x x x x x x x", 3: "one\ntwo\n\n  \none\none", 4: "#hash* $5 %| <b>& ok",
        5: " ".join(prose(3, 400) + prose(3, 20) + ["q"] + prose(3, 9)), 6: "\u00a0 ä\u3000b ß\x0bc", 7: "same line here\nsame line here\n",
    }
    got = with_counts(frame(spark, [row(i, t) for i, t in texts.items()])).collect()
    assert {r.doc_id: tuple(r[c] for c in COUNTS) for r in got} == {i: quality_counts(t) for i, t in texts.items()}


def test_sketches_merge_and_bound_the_error(spark):
    rows = [row(k, " ".join(["ab" * (1 + k % 40)] * 12 + prose(k, 3)), "en", f"s{k % 3}") for k in range(90)]
    counted = with_counts(frame(spark, rows))
    whole = {(r.rate, r.bucket): r.n for r in sketches(counted, "lang", "lang").collect()}
    parts = sketches(counted, "lang", "source").groupBy("rate", "bucket").sum("n").collect()
    assert whole == {(r.rate, r.bucket): r["sum(n)"] for r in parts}
    exact = sorted(r.word_chars * 1000 // r.n_words for r in counted.collect())
    limits = {(r._lang, r._source): r for r in thresholds(sketches(counted, "lang", "source")).collect()}
    assert len(limits) == 3 and len(exact) == 90
    # Thirty rows a source are too few, so all three sources share the language's limits.
    assert LEAST_ROWS > 30 and len({r[2:] for r in limits.values()}) == 1


def test_outliers_of_their_own_group_go(spark):
    clean = [row(k, " ".join(prose(k, 60)), "en", "web") for k in range(80)]
    noted = [row(1000 + k, " ".join(w + "*" for w in prose(k, 60)), "en", "notes") for k in range(80)]
    odd = [row(9000, " ".join(w + "*" for w in prose(5000, 60)), "en", "web")]
    got = {r.doc_id: r.kept for r in quality_rules(frame(spark, clean + noted + odd)).collect()}
    assert not got.pop(9000) and all(got.values())


def rates_of(text):
    counts = quality_counts(text)
    return 1000 * sum(not c.isalnum() for w in words(text) for c in w) // counts[1]


def test_the_same_text_stays_in_one_source_and_goes_in_another(spark):
    """Both sources have spread, and the text lies beyond the least distances in both: only their quantiles tell them apart."""
    marked = lambda seed, every: " ".join(w + ("*" if k % every == 0 else "") for k, w in enumerate(prose(seed, 120)))
    plain = [row(k, marked(k, 30 - k % 11), "en", "plain") for k in range(120)]
    noisy = [row(1000 + k, marked(k, 2 + k % 7), "en", "noisy") for k in range(120)]
    text = marked(7000, 3)
    least = RATES["marks"][-1]
    for rows in (plain, noisy):
        mine = sorted(rates_of(r[1]) for r in rows)
        assert rates_of(text) > mine[len(mine) // 2] + least and mine[-1] > mine[0]
    got = {r.doc_id: r.kept for r in quality_rules(frame(spark, [*plain, *noisy, row(5001, text, "en", "plain"), row(5002, text, "en", "noisy")])).collect()}
    assert not got.pop(5001) and got.pop(5002) and all(got.values())


@needs_data
def test_quantiles_decide_on_the_given_data(spark):
    """In most groups and rates the sketch, and not the least distance, sets the limit."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counted = materialise(with_counts(docs).drop("text")).filter("n_words >= 10 AND 100 * n_repeat_words <= 20 * n_words")
    limits = thresholds(materialise(sketches(counted, "lang", "source"))).collect()
    halves = [r[f"{n}_high"] - r[f"{n}_low"] > 2 * RATES[n][-1] if n in TWO_SIDED else r[f"{n}_high"] > RATES[n][-1] for r in limits for n in RATES]
    assert sum(halves) > 0.75 * len(halves)


def test_awkward_rows_and_columns(spark):
    df = with_clashes(awkward(spark))
    got = quality_rules(df)
    assert set(df.columns) <= set(got.columns)
    rows = got.collect()
    assert len(rows) == 14
    assert all(tuple(r[c] for c in COUNTS) == quality_counts(r.text) for r in rows)
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in rows)
    assert all(not r.kept for r in rows if r.text is None) and any(r.kept for r in rows)
    assert quality_rules(frame(spark, [])).count() == 0
