import os
import re

import numpy as np
import pytest
from helpers import awkward, frame, prose, row, with_clashes

from waterline.llm import mixing
from waterline.llm.mixing import TARGETS, Mix, mixed, mixing_rates

SF = os.environ.get("TEST_LABELS_DIR", "/root/testdata/sf0.1")
LABELS = "doc_id long, quality int, toxic int"


def corpus(n=300):
    rows, labels = [], []
    for k in range(n):
        w = prose(k, 30 + k % 40)
        kind = "junk" if k % 5 == 0 else "toxic" if k % 7 == 0 else "clean"
        text = " ".join(x + "$$" for x in w) if kind == "junk" else " ".join([*w, "vile", "awful"] if kind == "toxic" else w)
        rows.append(row(k, text))
        if k % 2:
            labels.append((k, int(kind != "junk"), int(kind == "toxic")))
    return rows, labels


@pytest.mark.parametrize("targets", [TARGETS, {"junk": 0.3, "toxic": 0.3, "clean": 0.4}])
def test_expected_tokens_meet_the_targets(spark, targets):
    rows, labels = corpus()
    got = mixing_rates(frame(spark, rows), frame(spark, labels, LABELS), targets).collect()
    total = sum(r.n_tokens for r in got)
    for name, weight in targets.items():
        assert abs(sum(r.n_tokens * r.rate * r[f"p_{name}"] for r in got) / total - weight) < 1e-3
    assert all(r.rate >= 0 and abs(r.p_junk + r.p_toxic + r.p_clean - 1) < 1e-5 for r in got)
    assert all(r.copies in (int(r.rate), int(r.rate) + 1) for r in got)
    right = [(r.p_junk > 0.5, r.p_toxic > 0.5) == (r.doc_id % 5 == 0, r.doc_id % 5 != 0 and r.doc_id % 7 == 0) for r in got]
    assert sum(right) > 0.97 * len(right)


def brute_rates(rows, targets, floor, rounds=4000):
    """Plain projected gradient over documents, in small steps of the same objective."""
    names = list(targets)
    one = [sum(r.n_tokens * r[f"p_{n}"] for r in rows) for n in names]
    want = [sum(one) * targets[n] for n in names]
    rates = [1.0] * len(rows)
    for _ in range(rounds):
        now = [sum(x * r.n_tokens * r[f"p_{n}"] for x, r in zip(rates, rows, strict=True)) for n in names]
        steps = [0.5 * (a - b) / o for a, b, o in zip(now, want, one, strict=True)]
        if max(abs(a - b) for a, b in zip(now, want, strict=True)) < 1e-7 * sum(one):
            break
        rates = [max(floor, x - sum(s * r[f"p_{n}"] for s, n in zip(steps, names, strict=True))) for x, r in zip(rates, rows, strict=True)]
    return rates


def test_rates_equal_brute_force_when_no_bound_is_met(spark):
    # Without active bounds the least change of rates is unique, and both ways lead there.
    rows, labels = corpus(160)
    near = {"junk": 0.15, "toxic": 0.1, "clean": 0.75}
    got = mixing_rates(frame(spark, rows), frame(spark, labels, LABELS), near, Mix(tolerance=1e-8, rounds=200)).collect()
    assert min(r.rate for r in got) > 0
    assert max(abs(a - r.rate) for a, r in zip(brute_rates(got, near, 0.0), got, strict=True)) < 1e-3


def test_unreachable_targets_come_near(spark):
    # Every posterior has a little of each domain, so none can vanish.
    rows, labels = corpus(160)
    got = mixing_rates(frame(spark, rows), frame(spark, labels, LABELS), {"junk": 0.0, "toxic": 0.5, "clean": 0.5}).collect()
    assert sum(r.n_tokens * r.rate * r.p_junk for r in got) < 0.02 * sum(r.n_tokens for r in got)


def test_floor_and_kept_domain(spark):
    rows, labels = corpus()
    docs, known = frame(spark, rows), frame(spark, labels, LABELS)
    got = mixing_rates(docs, known, TARGETS, floor=1.0).collect()
    assert min(r.rate for r in got) >= 1
    rated = mixing_rates(docs, known, TARGETS, keep=("clean", 1.2))
    clean = [r for r in rated.collect() if r.p_clean > 0.99]
    assert clean and all(1.1 < r.rate < 1.3 and r.copies >= 1 for r in clean)
    out = mixed(rated, docs.columns)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in rated.collect())


def test_awkward_rows(spark):
    df = with_clashes(awkward(spark))
    _, labels = corpus(20)
    known = frame(spark, [*labels, (None, 1, 1), (5, None, None), (5, 1, 0), (5, 0, 0)], LABELS)
    got = mixing_rates(df, known)
    assert set(df.columns) <= set(got.columns) and got.count() == 14
    assert all(r.rate is not None and r.copies >= 0 for r in got.collect())
    blank = mixing_rates(df, frame(spark, [], LABELS)).collect()
    assert {round(r.p_clean, 4) for r in blank} == {0.3333}
    assert mixing_rates(frame(spark, []), known).count() == 0


def plain_features(text, lexicon):
    """Bins of the statistics and presence of the lexicon's words, by hand."""
    body = text or ""
    w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", body.lower()) if x]
    log = lambda v: 0 if v <= 0 else min(15, v.bit_length())
    n, size = max(len(w), 1), max(len(body.encode()), 1)
    bins = [
        log(len(re.findall(r"[#*$%&|<>!]", body)) * 1000 // n), log(len(re.findall("[A-Z]", body)) * 1000 // size),
        log(sum(a == b for a, b in zip(w, w[1:], strict=False)) * 1000 // n), log(1000 - len(set(w)) * 1000 // n), log(len(w)),
        min(111, max(0, sum(map(len, w)) * 8 // n - 16)),
    ]
    x = [float(b == v) for b, width in zip(bins, mixing._WIDTHS, strict=True) for v in range(width)]
    return x + [float(word in w) for word in lexicon]


def test_posteriors_equal_a_plain_regression(spark):
    """The same rows fitted in plain Python by other steps: small gradient steps to the same optimum."""
    rows, labels = corpus(150)
    docs, how = frame(spark, rows), Mix(steps=3000)
    known = mixing.labelled_domains(frame(spark, labels, LABELS), how, mixing.DOMAINS, "doc_id")
    lexicon = mixing.learned_lexicon(docs.join(known, "doc_id"), 3, how, "text")
    assert {"vile", "awful"} <= set(lexicon)
    part = {r.doc_id: (r.domain, r.part) for r in known.selectExpr("doc_id", "domain", f"pmod(xxhash64(doc_id), {how.held}) AS part").collect()}
    x = {r[0]: np.array([*plain_features(r[1], lexicon), 1.0]) for r in rows}
    fitted = [(x[i], d) for i, (d, p) in part.items() if p]
    weights = np.zeros((3, len(x[0])))
    keep = np.full(len(x[0]), how.penalty)
    keep[-1] = 0.1
    for _ in range(6000):
        gradient = keep * weights
        for v, d in fitted:
            e = np.exp(weights @ v - (weights @ v).max())
            gradient += np.outer(e / e.sum() - np.eye(3)[d], v)
        weights -= 0.01 * gradient
        if np.abs(gradient).max() < 1e-5:
            break
    held = [(weights @ x[i], d) for i, (d, p) in part.items() if not p]
    loss = lambda f: sum(-np.log(np.exp(f * z - (f * z).max())[d] / np.exp(f * z - (f * z).max()).sum() + 1e-12) for z, d in held)
    factor = min((1.25**k for k in range(-12, 7)), key=lambda f: round(loss(f) / len(held), 9))
    got = mixing_rates(docs, frame(spark, labels, LABELS), how=how).collect()
    for r in got:
        z = factor * (weights @ x[r.doc_id])
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert np.abs(p - [r.p_junk, r.p_toxic, r.p_clean]).max() < 2e-3


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")
def test_labels_that_were_not_fitted(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    half = "pmod(xxhash64(doc_id, 7), 2) = {}"
    scored = mixing_rates(docs, labels.filter(half.format(0)), keep_text=False)
    domain = "CASE WHEN quality = 0 THEN 0 WHEN toxic = 1 THEN 1 WHEN quality = 1 THEN 2 END AS y"
    rows = scored.join(labels.filter(half.format(1)), "doc_id").selectExpr(domain, "array(p_junk, p_toxic, p_clean) AS p").dropna().collect()
    y, p = np.array([r.y for r in rows]), np.array([r.p for r in rows])
    right = p.argmax(axis=1) == y
    assert len(y) > 1500 and np.mean([right[y == k].mean() for k in range(3)]) > 0.88
    assert right[y == 2].mean() > 0.99 and right[y == 0].mean() > 0.95
    # How sure it says it is, against how often it is right, by tenths.
    bins = np.minimum((p.max(axis=1) * 10).astype(int), 9)
    assert sum(abs(right[bins == b].mean() - p.max(axis=1)[bins == b].mean()) * (bins == b).mean() for b in set(bins)) < 0.03
    assert (p.max(axis=1) > 0.999).mean() < 0.6
