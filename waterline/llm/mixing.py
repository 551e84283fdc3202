"""Mixing by soft membership: documents get rates that bring expected domain tokens to target weights.

1. A classifier learns domains from the labelled table: which of a learned lexicon's words a text has, and bins of a few
   statistics of it. It is a multinomial regression with a penalty, so words that come together share their weight and are not
   counted each for itself, and its posteriors are as soft as documents that were not fitted say. It gives every document a
   posterior over domains.
2. Rates r within bounds of the documents minimise sum over domains of (tokens(r) - target)^2 / tokens(1), where tokens(r) of a domain is
   the sum of rate * tokens * posterior. Projected gradient steps, scaled by 1 / tokens of the document, are
   r <- bounded(r - p . v) with v = (tokens(r) - target) / tokens(1). The scaled Hessian has a row-stochastic
   form, so its largest eigenvalue is 1 and the full step never overshoots.

All that touches documents is column expressions; the regression is fitted in the driver to a row for each of the bounded
labelled ids. As a step depends on the posterior alone, documents of equal posterior share a rate, and the
iterations run over one row per distinct posterior; between them only one number per domain reaches the driver.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waterline.sources.storage import materialise

#: Names are tried in this order; each is a condition on the labelled table.
DOMAINS = {"junk": "quality = 0", "toxic": "toxic = 1", "clean": "quality = 1"}
TARGETS = {"junk": 0.05, "toxic": 0.05, "clean": 0.9}

_SPLIT = r"[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_BINS = 16
#: Bins of a text's statistics: by doublings of thousandths, and word length in eighths of a letter between two and 16.
STATISTICS = {
    "symbols": "_log(_symbols * 1000 div greatest(n_tokens, 1))",
    "capitals": "_log(_capitals * 1000 div greatest(_bytes, 1))",
    "repeats": "_log(_repeats * 1000 div greatest(n_tokens, 1))",
    "distinct": "_log(1000 - _distinct * 1000 div greatest(n_tokens, 1))",
    "length": "_log(n_tokens)",
    "word_length": "least(111, greatest(0, _letters * 8 div greatest(n_tokens, 1) - 16))",
}
_WIDTHS = [112 if name == "word_length" else _BINS for name in STATISTICS]


@dataclass(frozen=True)
class Mix:
    """``max_rows`` bounds the labelled rows that are fitted (about), ``lexicon`` the words that are learned, which
    must be in ``least_df`` texts and reach ``least_chi``, far beyond what chance gives among many words."""

    max_rows: int = 10_000
    lexicon: int = 96
    least_df: int = 5
    least_chi: float = 40.0
    rounds: int = 60
    tolerance: float = 1e-6
    #: Of the regression: the penalty on half the squared weights, its gradient steps, and one labelled id in so many, which is not
    #: fitted but sets how soft the posteriors are.
    penalty: float = 1.0
    steps: int = 400
    held: int = 5


def _log_bin(v: str) -> str:
    return f"int(CASE WHEN {v} <= 0 THEN 0 ELSE least({_BINS - 1}, length(bin({v}))) END)"


def _words(text: str) -> str:
    return f"array_remove(split(lower(coalesce(`{text}`, '')), '{_SPLIT}'), '')"


def labelled_domains(labels: DataFrame, how: Mix, domains: Mapping[str, str], doc_id: str) -> DataFrame:
    """(doc_id, domain) of about ``max_rows`` labelled documents at most; several labels count as the first named domain."""
    order = {name: k for k, name in enumerate(domains)}
    which = "CASE " + " ".join(f"WHEN {condition} THEN {order[name]}" for name, condition in domains.items()) + " END"
    known = labels.select(F.col(doc_id).alias("doc_id"), F.expr(which).alias("domain")).dropna()
    known = known.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    n = known.count()
    if n > how.max_rows:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * how.max_rows / n))
    return known


def learned_lexicon(sample: DataFrame, n_domains: int, how: Mix, text: str) -> list[str]:
    """The words whose presence depends most on the domain by the chi-square statistic."""
    sizes = {r["domain"]: r["count"] for r in sample.groupBy("domain").count().collect()}
    n = sum(sizes.values())
    if not n:
        return []
    words = sample.select("domain", F.explode(F.array_distinct(F.expr(_words(text)))).alias("word"))
    counts = words.groupBy("word").agg(*[F.count_if(F.col("domain") == k).alias(f"d{k}") for k in range(n_domains)])
    total = " + ".join(f"d{k}" for k in range(n_domains))
    terms = [
        f"pow(d{k} - ({total}) * {sizes[k] / n!r}D, 2) / (({total}) * {sizes[k] / n!r}D)" for k in range(n_domains) if sizes.get(k)
    ]
    ranked = counts.filter(f"{total} >= {how.least_df}").select("word", F.expr(" + ".join(terms)).alias("chi"))
    ranked = ranked.filter(f"chi >= {how.least_chi}")
    # Rounded, so that the order of float sums cannot change the choice.
    best = ranked.orderBy(F.round("chi", 6).desc(), "word").limit(how.lexicon)
    return sorted(r["word"] for r in best.collect())


def featured(documents: DataFrame, lexicon: list[str], text: str) -> DataFrame:
    """Add n_tokens, _b0.. (binned statistics) and _hits (places of the lexicon's words in the text)."""
    listed = F.array(*[F.lit(w) for w in lexicon]) if lexicon else F.expr("array('')")
    body = documents.withColumns({"_words": F.expr(_words(text)), "_body": F.coalesce(F.col(text), F.lit(""))})
    body = body.withColumns(
        {
            "n_tokens": F.expr("bigint(size(_words))"),
            "_repeats": F.expr("size(filter(_words, (w, i) -> w = get(_words, i - 1)))"),
            "_distinct": F.expr("size(array_distinct(_words))"),
            "_letters": F.expr("char_length(array_join(_words, ''))"),
            "_found": F.array_intersect("_words", listed),
            "_bytes": F.expr("octet_length(_body)"),
            "_symbols": F.expr("octet_length(_body) - octet_length(regexp_replace(_body, '[#*$%&|<>!]+', ''))"),
            "_capitals": F.expr("octet_length(_body) - octet_length(regexp_replace(_body, '[A-Z]+', ''))"),
        }
    )
    bins = {f"_b{k}": F.expr(_log_bin(v[4:]) if v.startswith("_log(") else f"int({v})") for k, v in enumerate(STATISTICS.values())}
    places = F.transform("_found", lambda w: F.array_position(listed, w).cast("int"))
    return body.withColumns(bins | {"_hits": places}).drop(
        "_words", "_body", "_repeats", "_distinct", "_letters", "_found", "_bytes", "_symbols", "_capitals"
    )


def regression(x: np.ndarray, y: np.ndarray, n_domains: int, penalty: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features by domains) and bases of a multinomial regression: the rows' log loss and ``penalty`` / 2 times the squared weights.

    Accelerated gradient steps; the length of a step follows from the largest row.
    """
    one = np.eye(n_domains)[y]
    full = np.hstack([x, np.ones((len(x), 1))])
    keep = np.append(np.full(x.shape[1], penalty), 0.1)[:, None]
    pace = 1.0 / (0.5 * np.linalg.norm(full, 2) ** 2 + keep.max()) if len(x) else 1.0
    w = ahead = np.zeros((full.shape[1], n_domains))
    for k in range(steps):
        gradient = full.T @ (softmax(full @ ahead) - one) + keep * ahead
        w, before = ahead - pace * gradient, w
        ahead = w + k / (k + 3) * (w - before)
    return w[:-1], w[-1]


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def softness(logits: np.ndarray, y: np.ndarray) -> float:
    """The factor on the logits that gives rows which were not fitted the least log loss; 1 without such rows."""
    if not len(y):
        return 1.0
    factors = [1.25**k for k in range(-12, 7)]
    loss = [-np.log(softmax(f * logits)[np.arange(len(y)), y] + 1e-12).mean() for f in factors]
    return factors[int(np.argmin(np.round(loss, 9)))]


def posterior_sql(sample: DataFrame, n_domains: int, lexicon: list[str], how: Mix, doc_id: str) -> list[str]:
    """SQL of each domain's logit, from a row for every labelled id; an id in many rows counts with the least of them."""
    columns = [f"_b{k}" for k in range(len(STATISTICS))]
    rows = (
        sample.groupBy(F.col(doc_id).alias("id"))
        .agg(F.min(F.struct("domain", *columns, "_hits")).alias("row"), F.pmod(F.xxhash64(F.first(doc_id)), F.lit(how.held)).alias("part"))
        .select("id", "row.*", "part")
        .orderBy("id")
        .collect()
    )
    at = np.concatenate([[0], np.cumsum([*_WIDTHS, len(lexicon)])])
    x = np.zeros((len(rows), at[-1]))
    for k, r in enumerate(rows):
        x[k, [at[f] + r[c] for f, c in enumerate(columns)]] = 1
        x[k, [at[-2] + h - 1 for h in r["_hits"]]] = 1
    y = np.array([r["domain"] for r in rows], dtype=int)
    held = np.array([r["part"] == 0 for r in rows], dtype=bool)
    weights, bases = regression(x[~held], y[~held], n_domains, how.penalty, how.steps)
    factor = softness(x[held] @ weights + bases, y[held])
    logits = []
    for d in range(n_domains):
        own, base = np.round(weights[:, d] * factor, 9), round(float(bases[d] * factor), 9)
        listed = [f"array({', '.join(f'{float(v)!r}D' for v in own[a:b])})" for a, b in zip(at[:-1], at[1:], strict=True)]
        terms = [f"element_at({listed[f]}, {c} + 1)" for f, c in enumerate(columns)]
        if lexicon:
            terms.append(f"aggregate(_hits, 0D, (a, h) -> a + element_at({listed[-1]}, h))")
        logits.append(f"{base!r}D + " + " + ".join(terms))
    return logits


def with_posteriors(
    documents: DataFrame, labels: DataFrame, how: Mix, domains: Mapping[str, str], doc_id: str, text: str, keep_text: bool
) -> DataFrame:
    names = list(domains)
    known = labelled_domains(labels, how, domains, doc_id)
    ids = F.broadcast(known.withColumnRenamed("doc_id", "_labelled"))  # as many rows as ``max_rows`` allows
    sample = documents.select(doc_id, text).join(ids, F.col(doc_id) == F.col("_labelled"))
    lexicon = learned_lexicon(sample, len(names), how, text)
    measured = featured(documents, lexicon, text)
    measured = materialise(measured if keep_text else measured.drop(text))
    logits = posterior_sql(measured.join(ids, F.col(doc_id) == F.col("_labelled")), len(names), lexicon, how, doc_id)
    scored = measured.withColumns({f"_l{k}": F.expr(sql) for k, sql in enumerate(logits)})
    top = f"greatest({', '.join(f'_l{k}' for k in range(len(names)))})"
    scored = scored.withColumns({f"_e{k}": F.expr(f"exp(_l{k} - {top})") for k in range(len(names))})
    total = " + ".join(f"_e{k}" for k in range(len(names)))
    # Rounded, so equal texts have equal posteriors whatever the plan, and near-equal ones share a row below.
    scored = scored.withColumns({f"p_{n}": F.expr(f"round(_e{k} / ({total}), 6)") for k, n in enumerate(names)})
    return scored.drop(*[c for c in scored.columns if c[:2] in ("_l", "_e", "_b") and c[2:].isdigit()], "_hits")


def bounded_sql(rate: str, floor: float, ceiling: float | None, keep: tuple[str, float] | None) -> str:
    """A rate projected on its bounds; documents that are likely of the kept domain have at least 1."""
    low = f"{floor!r}D" if keep is None else f"CASE WHEN p_{keep[0]} > 0.5 THEN {max(1.0, floor)!r}D ELSE {floor!r}D END"
    above = f"greatest({low}, {rate})"
    return above if ceiling is None else f"least({ceiling!r}D, {above})"


def rate_sql(steps: list[list[float]], names: list[str], bounds: tuple) -> str:
    """The rate after these steps: each is projected, so they are folded in order."""
    if not steps:
        return bounded_sql("1D", *bounds)
    listed = ", ".join("array(" + ", ".join(f"{x!r}D" for x in step) + ")" for step in steps)
    dot = " + ".join(f"v[{k}] * p_{n}" for k, n in enumerate(names))
    return f"aggregate(array({listed}), 1D, (r, v) -> {bounded_sql(f'r - ({dot})', *bounds)})"


def fitted_steps(
    scored: DataFrame, targets: Mapping[str, float], how: Mix, bounds: tuple
) -> list[list[float]]:
    """The projected gradient's steps, one number per domain each."""
    names, keep = list(targets), bounds[2]
    profiles = scored.groupBy(*[f"p_{n}" for n in names]).agg(F.sum("n_tokens").alias("tokens"))
    profiles = materialise(profiles)

    def tokens(steps: list[list[float]]) -> list[float]:
        rate = rate_sql(steps, names, bounds)
        sums = profiles.withColumn("_r", F.expr(rate)).agg(*[F.sum(F.expr(f"tokens * p_{n} * _r")) for n in names])
        return [float(x or 0) for x in sums.first()]

    at_one = tokens([])
    share = sum(targets.values())
    total = sum(at_one)
    if keep:
        total = at_one[names.index(keep[0])] * keep[1] / targets[keep[0]] * share
    wanted = [total * targets[n] / share for n in names]
    steps: list[list[float]] = []
    now = at_one
    for _ in range(how.rounds):
        if total <= 0 or max(abs(a - b) for a, b in zip(now, wanted, strict=True)) <= how.tolerance * total:
            break
        # A domain without any tokens cannot be moved.
        steps.append([(a - b) / one if one > 0 else 0.0 for a, b, one in zip(now, wanted, at_one, strict=True)])
        now = tokens(steps)
    return steps


def mixing_rates(
    documents: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS, how: Mix = Mix(),
    domains: Mapping[str, str] = DOMAINS, doc_id: str = "doc_id", text: str = "text", floor: float = 0.0,
    ceiling: float | None = None, keep: tuple[str, float] | None = None, keep_text: bool = True,
) -> DataFrame:
    """All rows and columns of ``documents`` with n_tokens, p_<domain>, rate (expected copies) and copies.

    Expected tokens of the domains come as near to ``targets`` (weights) as rates from ``floor`` to ``ceiling`` can. Their total is
    that of the corpus, or such that domain ``keep[0]`` gets ``keep[1]`` times its own tokens; then no document whose posterior
    of that domain is over a half gets a rate below 1. copies is rate rounded up or down
    by a hash of the id, so that its expectation is the rate. Null and empty texts have no tokens and a rate all the same; null ids
    share a hash. Null labels are left out; without any label all posteriors are equal. Repeated rows
    get equal rates. Columns of ``documents`` that have the name of a result are replaced; an empty table gives an empty result.
    """
    names = list(targets)
    results = {"n_tokens", "rate", "copies", *[f"p_{n}" for n in names]}
    domains = {n: domains[n] for n in domains if n in targets}
    scored = with_posteriors(documents.drop(*results), labels, how, domains, doc_id, text, keep_text)
    bounds = (floor, ceiling, keep)
    steps = fitted_steps(scored, {n: targets[n] for n in domains}, how, bounds)
    rated = scored.withColumn("rate", F.expr(f"round({rate_sql(steps, list(domains), bounds)}, 6)"))
    chance = F.pmod(F.xxhash64(F.col(doc_id)), F.lit(1_000_000)) / 1_000_000
    return rated.withColumn("copies", F.floor(F.col("rate") + chance).cast("int"))


def mixed(rated: DataFrame, columns: list[str]) -> DataFrame:
    """Each row as often as its ``copies`` say, with ``columns`` only."""
    listed = [f"`{c}`" for c in columns]
    return rated.filter("copies > 0").select(*listed, F.explode(F.sequence(F.lit(1), "copies")).alias("_copy")).select(*listed)
