import collections
import itertools
import re

import numpy as np
from helpers import awkward, frame, prose, row, with_clashes, words

from waterline.llm.filter_audit import FILTERS, filter_audit, filter_failures, order_steps
from waterline.llm.term_matrix import row_totals, term_matrix

LABELS = "doc_id long, quality int, toxic int"


def failing(rows):
    """The letters each (doc_id, text) fails."""
    for doc_id, text in rows:
        body, w = text or "", words(text)
        checks = (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", body)) > 10 * len(body), bool(re.search(r"[#$%&*|]", body)),
            any(other is not None and (doc_id is None or other < doc_id) for other, x in rows if (x or "") == body),
        )
        yield {f for f, c in zip(FILTERS, checks, strict=True) if c}


def brute(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    fails = list(failing([(r[0], r[1]) for r in rows]))
    out = {}
    for part in {r[2] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, fails, strict=True) if (r[2] or "") == part]
        shapley = collections.Counter()
        for order in itertools.permutations(FILTERS):
            left = mine
            for k, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), k] = [
                    len(left), len(gone), sum(f in x[1] for x in mine) - len(gone), sum(x[1] == {f} for x in mine),
                    sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone),
                ]
        for key in out:
            if key[0] == part:
                out[key].append(shapley[key[1][key[2] - 1]])
    return out


def sample(spark):
    rows = [row(k, " ".join(prose(k, 60 + 15 * (k % 6)) * (1 + k % 2)), lang="en" if k % 3 else "fr") for k in range(24)]
    rows += [row(100 + k, rows[k][1], lang="de") for k in range(5)] + [row(200 + k, "SHOUT " * 40 * k + "#", lang=None) for k in range(4)]
    rows += [row(300, "X" * 10 + "y" * 90), row(301, "X" * 11 + "y" * 90), row(302, "100%", lang="")]
    rows += [row(303, " ".join(["a"] * 20 + [f"w{k}" for k in range(80)])), row(304, " ".join(["a"] * 22 + [f"w{k}" for k in range(79)]))]
    return rows + [tuple(r) for r in awkward(spark).collect()]


def test_counts_equal_brute_force(spark):
    rows = sample(spark)
    labels = [(k, k % 2, int(k % 5 == 0)) for k in range(12)] + [(3, 0, 1), (None, 1, 1), (100, 1, None), (777, 1, 1)]
    got = filter_audit(with_clashes(frame(spark, rows).repartition(5)), frame(spark, labels, LABELS))
    found = {(r.part, r.filter_order, r.step): list(r[3:]) for r in got.collect()}
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert found == brute(rows, labels)


def test_orders():
    steps = order_steps()
    assert len(steps) == 600 and len({s[:2] for s in steps}) == 600 and len({s[0] for s in steps}) == 120


def test_empty_tables(spark):
    labels = frame(spark, [], LABELS)
    assert filter_audit(frame(spark, []), labels).count() == 0
    one = filter_audit(frame(spark, [(None, None, None, None, None)]), labels).collect()
    assert len(one) == 600 and all(r.part == "" and r.kept + r.removed + r.redundant <= 1 for r in one)


def test_matrix_is_exact_whatever_the_shards(spark):
    rows = sample(spark)
    want = collections.Counter()
    for doc_id, text, *_ in rows:
        for word, n in collections.Counter(words(text)).items():
            want[doc_id, word] += n
    for parts, size in ((1, 1 << 22), (4, 3000)):
        matrix = term_matrix(frame(spark, rows).repartition(parts), shard_bytes=size)
        terms = {r.term: r.word for r in matrix.dictionary.collect()}
        assert sorted(terms) == list(range(len({w for _, w in want}))) and len(set(terms.values())) == len(terms)
        got, seen = collections.Counter(), 0
        for s in matrix.shards.collect():
            for k, about in enumerate(s.documents):
                low, high = s.indptr[k], s.indptr[k + 1]
                assert len(set(s.indices[low:high])) == high - low and all(np.diff(s.indices[low:high]) != 0)
                for term, n in zip(s.indices[low:high], s.counts[low:high], strict=True):
                    got[about.doc_id, terms[term]] += n
                seen += 1
        assert got == want and seen == len(rows)
        sums = sorted((r.doc_id or -1, r.n_words, r.n_distinct) for r in row_totals(matrix.shards).collect())
        assert sums == sorted((r[0] or -1, len(words(r[1])), len(set(words(r[1])))) for r in rows)


def test_a_word_goes_to_the_dictionary_once_a_shard(spark, monkeypatch):
    """However many documents hold it: the exchange has as many words as the shards have distinct ones, in a row a bucket."""
    from waterline.llm import term_matrix as module

    rows = [row(k, "same words in all of them") for k in range(500)]
    seen = {}
    real = module._numbered
    monkeypatch.setattr(
        module, "_numbered", lambda parts, width: seen.setdefault("found", (parts.selectExpr("explode(words)").count(), real(parts, width)))[1]
    )
    term_matrix(frame(spark, rows).coalesce(2))
    assert seen["found"][0] <= 2 * 6


def test_repeated_ids_are_no_copies(spark):
    text = " ".join(prose(5, 120))
    got = {(r.doc_id, r.E) for r in filter_failures(frame(spark, [row(1, text), row(1, text), row(2, text), row(None, text), row(3, None), row(4, "")])).collect()}
    assert got == {(1, False), (2, True), (None, True), (3, False), (4, True)}
