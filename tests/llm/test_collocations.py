import collections
import re

import numpy as np
from helpers import awkward, frame, prose, row, with_clashes

from waterline.llm import collocations as C


def pieces(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(rows, least, best):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for m in range(1, 6):
                for k in range(len(w) - m + 1):
                    f[lang, tuple(w[k : k + m])] += 1
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = []
    for lang in n:
        found = []
        for (of, w), a in candidates.items():
            inside = any(
                o == of and len(v) > len(w) and 100 * b >= 100 * a and any(v[k : k + len(w)] == w for k in range(len(v) - len(w) + 1))
                for (o, v), b in candidates.items()
            )
            if of == lang and not inside:
                cuts = [(1000 * a * n[lang] // (f[of, w[:k]] * f[of, w[k:]]), k) for k in range(1, len(w))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(w).encode(), a, f[of, w[:k]], f[of, w[k:]]))
        for rank, (score, _, phrase, a, left, right) in enumerate(sorted(found)[:best], 1):
            out.append((lang, rank, phrase.decode(), a, left, right, n[lang], -score))
    return sorted(out)


def sample():
    small = ["da", "de", "di", "do", "du", "ÄB", "x'y"]
    rows = []
    for k in range(60):
        w = prose(k, 40)
        text = " ".join(small[(i * 7 + len(x) + k) % 7] if i % 3 else x for i, x in enumerate(w))
        rows.append(row(k, text.replace(" de", ". de", k % 4).replace(" do", " do", 1), lang=["en", "fr", None][k % 3]))
    rows += [row(100 + k, " ".join(prose(700, 90)), lang="en") for k in range(15)]
    rows += [row(200, "la " * 400, lang="fr"), row(201, "One two, three Four. one TWO; three\x0bfour " * 30, lang="en"), row(202, "... ,,\n\t", lang="en")]
    return rows


def test_counts_equal_brute_force(spark):
    rows = sample() + [tuple(r) for r in awkward(spark).collect()]
    for every, parts in ((1, 3), (4, 1), (48, 5)):
        got = C.collocations(with_clashes(frame(spark, rows).repartition(parts)), least=10, best=40, every=every)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == brute(rows, 10, 40)


def test_empty_and_rare(spark):
    assert C.collocations(frame(spark, [])).count() == 0
    assert C.collocations(frame(spark, [row(1, None), row(2, "one two three")])).count() == 0


def test_chunks_overlap_once_and_copies_are_cut_alike(spark):
    text = " ".join(prose(3, 600))
    own = C.parse(frame(spark, [row(1, text)]), every=8).collect()
    both = C.parse(frame(spark, [row(k, " ".join(prose(50 + k, 30)) + " " + text) for k in range(20)]), every=8).collect()
    assert len(own) > 20
    assert len({r.chunk for r in own if not r.fresh} - {r.chunk for r in both}) <= 1  # all but the first cut's
    again = sum((len(r.chunk.split()) - (0 if r.fresh else C.OVERLAP)) * r.n for r in own)
    assert again == 600


def test_long_texts_without_a_cut_are_cut(spark):
    rows = C.parse(frame(spark, [row(1, "la " * 5000)]), every=1 << 40, most=50).collect()
    assert max(len(r.chunk.split()) for r in rows) <= 54 and sum(r.n for r in rows) == 100


def test_scores_pass_64_bits(spark):
    big = 3 * 10**12
    frequent = spark.createDataFrame(
        [("en", "a b", 2, big), ("en", "a", 1, big + 1), ("en", "b", 1, big + 7)], "lang string, phrase string, size int, f long"
    )
    totals = spark.createDataFrame([("en", 9 * 10**15)], "lang string, n long")
    assert C.scored(frequent, totals).first().score == 1000 * big * 9 * 10**15 // ((big + 1) * (big + 7))


def test_filter_lets_all_frequent_phrases_through(spark):
    phrases = [("en", " ".join(prose(k, 1 + k % 4))) for k in range(500)]
    table = C.bloom_filter(frame(spark, phrases, "lang string, phrase string"), 500)
    import pyarrow as pa

    from waterline.llm import arrowtext

    data, offsets = arrowtext.utf8(pa.array([p for _, p in phrases]))
    starts, _, first = arrowtext.word_bounds(data, offsets, arrowtext.BLANK)
    words = arrowtext.word_hashes(data, starts, arrowtext.BLANK)
    for k, (begin, end) in enumerate(zip(first[:-1], first[1:], strict=True)):
        h = C.lang_seeds(pa.array(["en"]))
        for i in range(begin, end):
            h = C.chain(h, words[i : i + 1])
        assert C.passes(h, table).all(), phrases[k]
    assert C.passes(np.arange(1, 20_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), table).mean() < 0.02
