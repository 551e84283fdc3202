import zlib

import numpy as np
import pyarrow as pa
from helpers import awkward, frame, prose, row, with_clashes

from waterline.llm import masked_lm
from waterline.llm.masked_lm import Network, Window, score_documents, text_words, vocabulary, windows

SMALL = Window(classes=4, per_class=8, rare=8, batch=256)


def test_vocabulary_counts_the_whole_corpus(spark):
    texts = [" ".join(["often"] * 9 + prose(k, 30)) for k in range(20)] + [None, "", "OFTEN! often?"]
    words = vocabulary(frame(spark, [row(k, t) for k, t in enumerate(texts)]), SMALL, "text")
    everything = [w for t in texts for w in (t or "").lower().replace("!", "").replace("?", "").split()]
    assert words.counts.sum() == len(everything) + (SMALL.size - SMALL.rare) + (np.exp(words.log_types[-8:]) * 0 + 1).sum()
    assert round(np.exp(words.log_types[-8:]).sum()) + 24 == len(set(everything))
    often = text_words(pa.array(["often"]))[0]
    assert words.frequent[0] == often[0] and words.counts[0] == 9 * 20 + 2 + 1


def test_probabilities_sum_to_one_and_gradients_lower_the_loss():
    how = Window(classes=3, per_class=4, rare=4, side=1, width=5)
    net = Network.initial(how, np.arange(1.0, 13))
    context = np.array([[3], [12]])
    total = sum(np.exp(net.log_probabilities(context, np.array([t]))[0]) for t in range(12))
    assert abs(total - 1) < 1e-5
    draw = np.random.default_rng(0)
    left = draw.integers(0, 12, 4000)
    target = (left * 5 + 1) % 12
    before = net.log_probabilities(np.stack([left, left]), target).mean()
    for _ in range(60):
        net.log_probabilities(np.stack([left, left]), target, 1.0)
    assert net.log_probabilities(np.stack([left, left]), target).mean() > before + 1


def test_windows_stop_at_the_text():
    how = Window(classes=1, per_class=8, rare=4, side=2)
    around = windows(np.array([1, 2, 3, 4, 5]), np.array([0, 3, 3, 5]), how)
    assert around.tolist() == [[8, 8, 1, 8, 8], [8, 1, 2, 8, 4], [2, 3, 8, 5, 8], [3, 8, 8, 8, 8]]


def test_ordered_text_scores_above_shuffled(spark):
    phrase = prose(1, 12)
    rows = [row(k, " ".join(phrase * 20)) for k in range(60)] + [row(1000 + k, " ".join(sorted(phrase * 20, key=lambda w: zlib.crc32(f"{w} {k}".encode()) % 7))) for k in range(3)]
    got = {r.doc_id: r for r in score_documents(frame(spark, rows), SMALL).collect()}
    assert all(r.n_tokens == 240 and abs(r.per_token * 240 - r.log_likelihood) < 1e-6 for r in got.values())
    assert min(got[k].per_token for k in range(60)) > max(got[1000 + k].per_token for k in range(3))


def test_words_of_a_bucket_share_it_by_their_counts(spark, monkeypatch):
    """Probabilities of all words of one context add up to one, whether a count is held by the tasks or joined."""
    how = Window(classes=2, per_class=4, rare=2, side=1, batch=64)
    texts = [f"w{k}" for k in range(20) for _ in range(k + 1)] + ["", None]
    rows = frame(spark, [row(k, t) for k, t in enumerate(texts)])
    found = {}
    for held in (1 << 16, 3, 0):
        monkeypatch.setattr(masked_lm, "HELD", held)
        words = vocabulary(rows, how, "text")
        assert words.beyond == max(0, 20 - 6 - held)
        got = {r.doc_id: r.log_likelihood for r in score_documents(rows.coalesce(1), how).collect()}
        found[held] = [got[k] for k in range(len(texts))]
    single = {t: x for t, x in zip(texts[:-2], found[0], strict=False)}
    assert abs(sum(np.exp(x) for x in single.values()) - 1) < 1e-4
    assert np.allclose(found[0], found[3], atol=1e-6) and np.allclose(found[0], found[1 << 16], atol=1e-6)


def test_awkward_rows(spark):
    got = score_documents(with_clashes(awkward(spark)), SMALL).collect()
    assert len(got) == 14
    by_id = {r.doc_id: r for r in got if r.doc_id}
    assert all(by_id[k].n_tokens == 0 and by_id[k].log_likelihood == 0 and by_id[k].per_token is None for k in (1, 2, 3))
    assert all(np.isfinite(r.log_likelihood) and r.log_likelihood < 0 for r in got if r.n_tokens)
    assert score_documents(frame(spark, []), SMALL).count() == 0
