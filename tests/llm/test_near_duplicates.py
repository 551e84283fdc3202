import numpy as np
import pytest
from helpers import awkward, frame, near_groups, prose, row, shingles, with_clashes
from pyspark.sql import functions as F

from waterline.llm.components import components
from waterline.llm.minhash import MinHash, confirmed_links, estimated, minima, near_duplicates, packed


def edited(words, places):
    return [f"{w}x" if k in places else w for k, w in enumerate(words)]


def test_groups_equal_brute_force(spark):
    docs = []
    for family in range(12):
        base = prose(family + 10, 80 + 20 * family)
        for copy in range(6):
            docs.append((100 * family + copy, " ".join(edited(base, {(13 * copy * j) % len(base) for j in range(copy)}))))
    docs += [(5000 + k, " ".join(prose(900 + k, 30) + prose(77, 60))) for k in range(40)]
    got = {r.doc_id: r for r in near_duplicates(frame(spark, [row(i, t) for i, t in docs])).collect()}
    want = near_groups(docs)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(shingles(dict(docs)[i])) for i, r in got.items())


@pytest.mark.parametrize("block", [4, 192])
def test_a_large_family_in_small_blocks(spark, block):
    base = prose(5, 120)
    docs = [(k, " ".join(edited(base, {k % 120, (k * 7) % 120, (k * 31) % 120}))) for k in range(60)]
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, [row(i, t) for i, t in docs]), MinHash(block=block)).collect()}
    assert got == near_groups(docs)


def test_threshold_is_exact(spark):
    # 60 shared shingles of 80 in all are linked, one less is not.
    base = prose(6, 74)
    docs = [(1, " ".join(base[:64])), (2, " ".join(base[:64] + prose(7, 20))), (3, " ".join(prose(8, 1) + base[:64] + prose(9, 20)))]
    sets = {i: shingles(t) for i, t in docs}
    assert 100 * len(sets[1] & sets[2]) == 75 * len(sets[1] | sets[2])
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, [row(i, t) for i, t in docs])).collect()}
    assert got == near_groups(docs)


def test_awkward_rows(spark):
    got = near_duplicates(with_clashes(awkward(spark))).collect()
    assert len(got) == 14
    by_id = {r.doc_id: r for r in got}
    assert [by_id[k].n_shingles for k in (1, 2, 3, 8)] == [0, 0, 0, 1]
    assert all(by_id[k].kept for k in (1, 2, 3, 4, 5, 7, 8, 9, 11)) and by_id[6].component_id == 5 and by_id[10].component_id == 8
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).count() == 0


def test_estimate_is_corrected_for_chance():
    how = MinHash()
    a, b = how.hashing()
    draw = np.random.default_rng(0)
    one = draw.integers(0, 2**63, 400, dtype=np.uint64)
    sets = [one, np.concatenate([one[:300], draw.integers(0, 2**63, 100, dtype=np.uint64)]), draw.integers(0, 2**63, 400, dtype=np.uint64)]
    bits = packed(np.stack([minima(s, a, b) for s in sets]), how.bits)
    near = estimated(bits, bits, how.bits, how.size)
    assert near[0, 0] == 1 and abs(near[0, 1] - 0.6) < 0.12 and abs(near[0, 2]) < 0.12


@pytest.mark.parametrize("n, m, pairs", [(3, 4, 6000), (6, 8, 6000), (48, 64, 500)])
def test_estimates_of_sets_of_any_size_spread_as_if_independent(n, m, pairs):
    how = MinHash()
    a, b = how.hashing()
    draw, near = np.random.default_rng(5), []
    for _ in range(pairs):
        s = draw.integers(0, 2**64, m, dtype=np.uint64)
        bits = packed(np.stack([minima(s[:n], a, b), minima(s, a, b)]), how.bits)
        near.append(estimated(bits[:1], bits[1:], how.bits, how.size)[0, 0])
    nominal = (0.8125 * 0.1875 / how.size) ** 0.5 / 0.75
    assert abs(np.std(near) - nominal) < 0.15 * nominal and min(near) > how.cutoff()


@pytest.mark.parametrize("n, m", [(3, 4), (6, 8)])
def test_no_link_of_small_sets_is_lost(n, m):
    draw = np.random.default_rng(5)
    for _ in range(10_000):
        s = draw.integers(0, 2**64, m, dtype=np.uint64)
        assert confirmed_links([1, 2], [np.sort(s[:n]), np.sort(s)], [0, 0], MinHash()) == [(2, 1)]


def test_components_of_chains_stars_and_loops(spark):
    links = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(50)] + [(7000, 7000), (None, 3)]
    got = dict(components(frame(spark, links, "a long, b long"), "a", "b").collect())
    assert got == {k: 0 for k in range(201)} | {1000 + k: 1000 for k in range(50)} | {7000: 7000}


def test_string_ids(spark):
    df = frame(spark, [row(1, " ".join(prose(2, 30))), row(2, " ".join(prose(2, 30)))]).withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert {(r.doc_id, r.component_id) for r in near_duplicates(df).collect()} == {("d1", "d1"), ("d2", "d1")}
