import zlib

import numpy as np
import pyarrow as pa
from helpers import awkward, frame, prose, row, with_clashes

from waterline.llm.additive import Boosting, fit, tree_steps
from waterline.llm.quality_classifier import FEATURES, fit_quality, score_quality, text_features

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=240):
    rows, labels = [], []
    for k in range(n):
        w, bad = prose(k, 40 + k % 50), k % 3 == 0
        rows.append(row(k, " ".join(w[: len(w) // 3] * 3 if bad and k % 2 else [x + "!!*" for x in w] if bad else w)))
        labels.append((k, 0 if bad else 1, 0))
    return rows, labels


def test_held_out_rows_are_told_apart(spark):
    rows, labels = corpus()
    docs = frame(spark, rows)
    got = score_quality(docs, fit_quality(docs, frame(spark, labels, LABELS))).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {k for k in range(240) if zlib.crc32(str(k).encode()) % 3 == 1}
    assert np.mean([r.predicted == labels[r.doc_id][1] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_held_out_labels_do_not_matter(spark):
    rows, labels = corpus(60)
    docs = frame(spark, rows)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in labels]
    one, two = (
        sorted((r.doc_id, r.score) for r in score_quality(docs, fit_quality(docs, frame(spark, x, LABELS))).collect()) for x in (labels, flipped)
    )
    assert one == two


def test_sample_bound_and_bad_labels(spark):
    rows, labels = corpus(120)
    labels += [(None, 1, 0), (5, None, 0), (3, 0, 0), (99_999, 1, 1)]
    docs = frame(spark, rows)
    assert len(fit_quality(docs, frame(spark, labels, LABELS), max_rows=30).tables) == len(FEATURES)
    blank = fit_quality(docs, frame(spark, [], LABELS))
    assert {r.score for r in score_quality(docs, blank).collect()} == {0.5}


def test_interactions_are_learned():
    draw = np.random.default_rng(1)
    x = draw.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = fit(x, y, Boosting(pairs=2, rounds=20, pair_rounds=40))
    assert model.pairs[0] == (1, 0) and ((model.scores(x) >= 0.5) == y).mean() > 0.9


def test_shallow_tree_steps():
    g, h = np.array([4.0, 4.0, -4.0, -4.0]), np.full(4, 4.0)
    assert np.allclose(tree_steps(g, h, Boosting(ridge=0.0)), [1, 1, -1, -1])
    assert np.allclose(tree_steps(np.zeros(3), np.ones(3), Boosting()), 0)


def test_features_do_not_leak_between_rows():
    texts = ["aa aa aa", "", None, " x ", "Qa!\nQa!\n", "é é"]
    together = text_features(pa.array(texts))
    alone = np.concatenate([text_features(pa.array([t], pa.string())) for t in texts])
    assert np.array_equal(together, alone) and not together[1].any() and not together[2].any()


def test_awkward_rows(spark):
    df = with_clashes(awkward(spark))
    rows, labels = corpus(30)
    model = fit_quality(frame(spark, rows), frame(spark, labels, LABELS))
    got = score_quality(df, model).collect()
    assert len(got) == 14 and all(r.score is not None and r.held_out is not None for r in got)
    assert score_quality(frame(spark, []), model).count() == 0


def test_an_id_in_many_rows_comes_to_the_driver_once(spark, monkeypatch):
    from waterline.llm import quality_classifier

    ids = [k for k in range(60) if zlib.crc32(str(k).encode()) % 3 != 1]
    rows = [row(k, " ".join(prose(k, 40 + k))) for k in ids] + [row(ids[0], " ".join(prose(900 + k, 30 + k))) for k in range(200)]
    labels = frame(spark, [(k, k % 2) for k in ids], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality_classifier, "fit", lambda x, y, how: seen.append((x, y)))
    quality_classifier.fit_quality(frame(spark, rows), labels)
    assert len(seen[0][0]) == len(seen[0][1]) == len(ids)
