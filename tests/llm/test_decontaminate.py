import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, frame, prose, row, with_clashes

from waterline.llm.decontaminate import Search, block_max_wand, build_index, leaks, split_item, without_leaks

ITEMS = [(k, " ".join(prose(700 + k, 12)) + ". " + " ".join(prose(800 + k, 14)) + "?\n" + " ".join(prose(900 + k, 8)) + ".") for k in range(30)]
ITEM_SCHEMA = "item_id long, text string"


@pytest.mark.parametrize("threshold", [0.05, 0.3, 0.7])
def test_wand_finds_what_scoring_everything_finds(threshold):
    index = build_index([(i, *split_item(t)) for i, t in ITEMS], Search(block=3, stride=16))
    dense = np.zeros((len(index.vocabulary), len(index.segment_item)))
    for t in range(len(index.vocabulary)):
        at = slice(index.begin[t], index.begin[t + 1])
        dense[t, index.segments[at]] = index.impacts[at]
    assert np.allclose(dense.sum(axis=0), 1)
    draw = np.random.default_rng(3)
    for n in (1, 5, 40, 200):
        terms = np.sort(draw.choice(len(index.vocabulary), min(n, len(index.vocabulary)), replace=False))
        scores = dense[terms].sum(axis=0)
        want = {(k, round(s, 9)) for k, s in enumerate(scores) if s >= threshold - 1e-9}
        assert {(k, round(s, 9)) for k, s in block_max_wand(index, terms, threshold)} == want


def documents():
    rows = [row(k, " ".join(prose(k, 150))) for k in range(40)]
    for k in range(10):
        w = prose(3000 + k, 220)
        rows.append(row(100 + k, " ".join([*w[: 20 * k], ITEMS[k][1], *w[20 * k :]])))
    rows.append(row(200, ITEMS[0][1].upper().replace(" ", "\n")))
    rows.append(row(201, " ".join(prose(50, 30)) + " " + ITEMS[1][1] + " " + ITEMS[2][1]))
    question, answer = split_item(ITEMS[3][1])
    rows += [row(300, question + " " + " ".join(prose(60, 40))), row(301, answer)]
    return rows


def test_leaks_are_found_and_clean_texts_are_not(spark):
    docs, bench = frame(spark, documents()), frame(spark, ITEMS, ITEM_SCHEMA)
    got = {(r.doc_id, r.item_id) for r in leaks(docs, bench).collect()}
    # A question without its answer, or the reverse, is no leak.
    want = {(100 + k, k) for k in range(10)} | {(200, 0), (201, 1), (201, 2)}
    assert got == want
    kept = {r.doc_id for r in without_leaks(docs, bench).collect()}
    assert kept == {r[0] for r in documents()} - {d for d, _ in want}
    several = {(r.doc_id, r.item_id) for r in leaks(docs, bench, Search(index_words=300)).collect()}
    assert several == want


def test_long_items_and_question_columns(spark):
    long = (1, " ".join(prose(40, 400)) + ". " + " ".join(prose(41, 30)))
    docs = frame(spark, [row(1, " ".join(prose(1, 500)) + " " + long[1] + " tail"), row(2, " ".join(prose(2, 900)))])
    assert [(r.doc_id, r.item_id) for r in leaks(docs, frame(spark, [long], ITEM_SCHEMA)).collect()] == [(1, 1)]
    bench = frame(spark, [(7, "who " + " ".join(prose(9, 12)), "forty two")], "item_id long, question string, answer string")
    docs = frame(spark, [row(1, "who " + " ".join(prose(9, 12)) + "? Forty-two."), row(2, "who " + " ".join(prose(9, 12)) + "? Nobody knows.")])
    assert [r.doc_id for r in leaks(docs, bench, question="question", answer="answer").collect()] == [1]


def test_awkward_rows(spark):
    bench = frame(spark, [(None, None), (1, ""), (2, "tiny"), (2, "tiny"), (3, ITEMS[0][1])], ITEM_SCHEMA)
    df = with_clashes(awkward(spark))
    got = sorted((r.doc_id, r.item_id) for r in leaks(df, bench).collect())
    assert got == [(8, 2), (8, 2), (10, 2), (10, 2)]
    kept = without_leaks(df, bench)
    assert kept.columns == df.columns and kept.count() == 12
    empty = frame(spark, [], ITEM_SCHEMA)
    assert leaks(df, empty).count() == 0 and without_leaks(df, empty).count() == 14
    assert leaks(frame(spark, []), bench).count() == 0


def test_item_without_words_is_never_found():
    index = build_index([(1, "", ""), (2, "?!", None)], Search())
    assert len(index.vocabulary) == 0 and pa.array(["x"]) is not None
