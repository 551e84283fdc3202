import re

from helpers import awkward, frame, prose, row, with_clashes

from waterline.llm.licenses import PER_CENT, TEMPLATES, bigrams, license_scan, size_bounds


def brute(text):
    found = {}
    parts = [("line", k, u) for k, u in enumerate(text.split("\n"))]
    parts += [("paragraph", k, u) for k, u in enumerate(re.split(r"\n[ \t\r]*\n", text)) if "\n" in u]
    for kind, place, unit in parts:
        grams = set(bigrams(unit))
        for name, texts in TEMPLATES.items():
            best = max((2 * len(grams & set(bigrams(t))) / (len(grams) + len(bigrams(t))) for t in texts if grams), default=0)
            if best * 100 >= PER_CENT:
                found.setdefault(name, []).append((best, kind, place))
    first = lambda hits, kind: min((p for _, k, p in hits if k == kind), default=-1)
    return {(n, round(max(h)[0], 9), first(h, "line"), first(h, "paragraph"), len(h)) for n, h in found.items()}


def test_scan_equals_brute_force(spark):
    filler = [" ".join(prose(k, 12)) for k in range(40)]
    texts = {k: "\n".join([filler[k], t, filler[k + 1]]) for k, t in enumerate(t for ts in TEMPLATES.values() for t in ts)}
    wrapped = re.sub(r"((?:\S+\s+){9})", r"\1\n", TEMPLATES["MIT"][2])
    texts |= {
        50: "\n\n".join([filler[3], wrapped, filler[4]]), 51: "ALL RIGHTS   reserved", 52: "All rights are reserved here, friends",
        53: "Licensed under the apache license version 2.0!", 54: "\n \n\n" + wrapped.replace("free of charge", "gratis") + "\n\t\nx\ny",
        55: "Permission is hereby granted.", 56: " ".join(wrapped.split()[:30]),
    }
    got = {}
    for r in license_scan(frame(spark, [row(i, t) for i, t in texts.items()])).collect():
        got.setdefault(r.doc_id, set()).add((r.license, round(r.dice, 9), r.line, r.paragraph, r.n_units))
    assert got == {i: brute(t) for i, t in texts.items() if brute(t)}
    assert {r[0] for r in got[50]} == {"MIT"} and 55 not in got and 56 not in got


def test_size_bounds_are_safe_and_tight():
    for n in range(1, 60):
        low, high = size_bounds(n, PER_CENT)
        for m in range(1, 120):
            assert (200 * min(n, m) >= PER_CENT * (n + m)) == (low <= m <= high)


def test_awkward_rows(spark):
    df = with_clashes(awkward(spark))
    assert license_scan(df).count() == 0
    mine = frame(spark, [row(1, "All rights reserved."), row(1, "All rights reserved."), row(None, "All rights reserved.")])
    got = {(r.doc_id, r.n_units) for r in license_scan(with_clashes(mine)).collect()}
    assert got == {(1, 1), (None, 1)}
    assert license_scan(frame(spark, [])).count() == 0 and license_scan(mine, {"none": ("word",)}).count() == 0
