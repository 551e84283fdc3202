"""Small documents with every awkward case, and brute-force versions of the operators."""

import collections
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns with names that operators use for their own results or inside.
CLASHING = "shard int, size int, slot int, kept boolean, score double, rate double, copies int, n_words int, digest string, _piece int, n_tokens int"
VOCABULARY = [a + b + c for a in "bdfgklmnprst" for b in "aeiou" for c in ("n", "r", "st", "l")]


def prose(seed, n):
    """``n`` words that depend on the seed alone; different seeds share no five words in a row in practice."""
    state, words = seed * 7919 + 17, []
    for _ in range(n):
        state = (state * 6364136223846793005 + 1442695040888963407) % 2**64
        words.append(VOCABULARY[(state >> 33) % len(VOCABULARY)])
    return words


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text))


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def awkward(spark):
    """Nulls in every column, empty and blank texts, a very long text, exact ties and repeated rows."""
    long = " ".join(prose(1, 30_000))
    rows = [
        row(1, None), row(2, ""), row(3, " \t\n \x0b "), row(4, long), row(5, " ".join(prose(2, 60))),
        row(6, " ".join(prose(2, 60)).upper()), row(6, " ".join(prose(2, 60)).upper()), row(None, " ".join(prose(3, 40))),
        row(7, " ".join(prose(4, 50)), None, None), row(8, "tiny"), row(9, "ÄÖ ÿ \u3000x \u00a0 y"), row(10, "tiny"),
        (None, None, None, None, None), row(11, "a" * 5000),
    ]
    return frame(spark, rows)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = words(low)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def groups(nodes, links):
    """Smallest node reachable from each."""
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_groups(docs):
    sets = {i: shingles(t) for i, t in docs}
    ids = sorted(sets)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[:k]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return groups(ids, links)


def quality_counts(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    seen = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    covered = {k + j for k in range(len(w) - 4) if seen[tuple(w[k : k + 5])] > 1 for j in range(5)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def with_clashes(df):
    """The same rows with extra columns of clashing names."""
    return df.selectExpr("*", *[f"CAST(NULL AS {c.split()[1]}) AS {c.split()[0]}" for c in CLASHING.split(", ")])
