"""Reference SQL for the registered queries, in DuckDB's dialect, written without the library."""

from __future__ import annotations

import re

from waterline.registry import fixtures as fx
from waterline.registry import queries as q

POSITIONS = ("QB", "RB", "WR", "TE")
POOLS = (*POSITIONS, "FLEX", "SUPERFLEX")


def _case(column: str, names: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in names.items()) + f" ELSE {column} END"


def _r(*columns: str) -> str:
    return ", ".join(f"{_6(c)} AS {c}" for c in columns)


def _outputs(sql: str) -> str:
    """Spell out ``R6[x]``: an output double as the queries round it."""
    return re.sub(r"R6\[(.*?)\]", lambda m: _6(m[1]), sql, flags=re.S)


def _6(value: str) -> str:
    return f"(round(({value}) + {q.SHIFT}, {q.OUTPUT_DIGITS}) + 0.0)"


def _erf(x: str) -> str:
    t = f"(1.0::DOUBLE / (1.0::DOUBLE + 0.3275911::DOUBLE * abs({x})))"
    poly = (
        f"((((1.061405429::DOUBLE * {t} - 1.453152027::DOUBLE) * {t} + 1.421413741::DOUBLE) * {t} "
        f"- 0.284496736::DOUBLE) * {t} + 0.254829592::DOUBLE) * {t}"
    )
    curve = f"sign({x}) * (1.0::DOUBLE - {poly} * exp(-({x}) * ({x})))"
    return f"(CASE WHEN abs({x}) < 1e-10 THEN 0.0::DOUBLE ELSE {curve} END)"


def _share(score: str, avg: str) -> str:
    """Chance to win with ``score`` in place of the pool's average (team columns tavg and tstd)."""
    z = f"((({score}) - ({avg})) / (tstd * sqrt(2.0::DOUBLE)))"
    return f"(0.5::DOUBLE * (1.0::DOUBLE + {_erf(z)}))"


def _above(score: str, avg: str, replacement: str) -> str:
    return f"({_share(score, avg)} - {_share(replacement, avg)})"


WEEKLY = f"""
weekly AS (
  SELECT CAST(l_partkey AS VARCHAR) AS player, p_brand AS team, {_case("p_type", fx.PART_POSITIONS)} AS pos,
         CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS week,
         sum(l_quantity) AS rec, sum(l_extendedprice) AS yds, sum(l_discount) * 10 AS ints, sum(l_tax) * 10 AS fl
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
"""


def _elig(cfg, source: str = "weekly", p: str = "") -> str:
    s = cfg.scoring
    extra = f" + CASE WHEN pos = 'TE' THEN rec * {s.te_premium!r}::DOUBLE ELSE 0 END"
    return f"""
{p}elig AS (
  SELECT * , player || '-' || pos AS id,
         round(rec * {s.rec!r}::DOUBLE{extra} + yds * 0.0001::DOUBLE - ints * 2 - fl * 2, 9) AS fpts
  FROM {source}
  WHERE pos IN {POSITIONS} AND year >= {cfg.start_year} AND week BETWEEN 1 AND {cfg.weeks})
"""


def _ranked(cfg, ties: str = "id", p: str = "") -> str:
    c = {pool: cfg.starters(pool) for pool in POOLS}
    slots = "CASE pos " + " ".join(f"WHEN '{x}' THEN {c[x]}" for x in POSITIONS) + " END"
    order = f"ORDER BY fpts DESC, {ties}"
    return f"""
{p}k1 AS (SELECT *, row_number() OVER (PARTITION BY year, week, pos {order}) AS pr FROM {p}elig),
{p}k2 AS (SELECT *, max(CAST(pr <= {slots} AS INTEGER)) OVER (PARTITION BY year, week, id) AS used FROM {p}k1),
{p}k3 AS (SELECT *, CASE WHEN used = 0 AND pos <> 'QB' THEN row_number() OVER
         (PARTITION BY year, week, used = 0 AND pos <> 'QB' {order}) END AS fr FROM {p}k2),
{p}k4 AS (SELECT *, greatest(used, max(CASE WHEN fr <= {c["FLEX"]} THEN 1 ELSE 0 END)
         OVER (PARTITION BY year, week, id)) AS used2 FROM {p}k3),
{p}ranked AS (SELECT *, CASE WHEN used2 = 0 THEN row_number() OVER (PARTITION BY year, week, used2 = 0 {order}) END AS sr
         FROM {p}k4)
"""


def _pool_rows(cfg, p: str = "") -> str:
    parts = []
    for pool in POOLS:
        n = cfg.starters(pool)
        rank = {"FLEX": "fr", "SUPERFLEX": "sr"}.get(pool, "pr")
        where = f"{rank} <= {2 * n}" + (f" AND pos = '{pool}'" if pool in POSITIONS else "")
        role = f"CASE WHEN {rank} <= {n} THEN 'starter' ELSE 'replacement' END"
        parts.append(f"SELECT year, week, id, '{pool}' AS pool, {role} AS role, fpts FROM {p}ranked WHERE {where}")
    return f"{p}pool_rows AS (" + " UNION ALL ".join(parts) + ")"


def _model(cfg, p: str = "") -> str:
    spine = ", ".join(f"('{x}', {cfg.roster[x]}, {cfg.starters(x)})" for x in POOLS)
    top, rest = "FILTER (WHERE role = 'starter')", "FILTER (WHERE role = 'replacement')"
    return f"""
{_pool_rows(cfg, p)},
{p}stats AS (
  SELECT y.year, s.pool, s.slots, s.nominal, coalesce(avg(fpts) {top}, 0) AS avg,
         CASE WHEN count(fpts) {top} <= 1 THEN greatest(0.2 * coalesce(avg(fpts) {top}, 0), 1)
              ELSE stddev_pop(fpts) {top} END AS std,
         coalesce(avg(fpts) {rest}, 0) AS replacement, count(fpts) {top} AS n
  FROM (SELECT DISTINCT year FROM {p}elig) y
  CROSS JOIN (VALUES {spine}) AS s(pool, slots, nominal)
  LEFT JOIN {p}pool_rows r ON r.year = y.year AND r.pool = s.pool GROUP BY ALL),
{p}team AS (SELECT year, sum(avg * slots) AS tavg, greatest(sqrt(sum(std * std * slots)), 1) AS tstd
         FROM {p}stats GROUP BY year)
"""


def _seasons(cfg, facts: str = "elig", p: str = "") -> str:
    """Season values over the dense season x week grid."""
    return f"""
{p}grid AS (
  SELECT s.*, w.week, e.fpts AS actual, coalesce(e.fpts, b.replacement) AS score,
         b.avg AS ba, b.replacement AS br, f.avg AS fa, f.replacement AS frp, x.avg AS xa, x.replacement AS xr,
         x.n AS xn, t.tavg, t.tstd
  FROM (SELECT DISTINCT year, player, team, pos FROM {p}{facts}) s
  CROSS JOIN (SELECT unnest(range(1, {cfg.weeks + 1})) AS week) w
  LEFT JOIN {p}{facts} e ON e.year = s.year AND e.player = s.player AND e.team = s.team AND e.pos = s.pos
       AND e.week = w.week
  JOIN {p}stats b ON b.year = s.year AND b.pool = s.pos
  JOIN {p}stats f ON f.year = s.year AND f.pool = 'FLEX'
  JOIN {p}stats x ON x.year = s.year AND x.pool = 'SUPERFLEX'
  JOIN {p}team t ON t.year = s.year),
{p}valued AS (
  SELECT *, {_above("score", "ba", "br")} AS w_war,
         CASE WHEN pos <> 'QB' THEN {_above("score", "fa", "frp")} END AS w_flex,
         CASE WHEN xn > 0 THEN {_above("score", "xa", "xr")} END AS w_super FROM {p}grid),
{p}seasons AS (
  SELECT year, player, team, pos, sum(w_war) AS war, sum(w_flex) AS flex_war, sum(w_super) AS superflex_war,
         CAST(count(actual) AS INTEGER) AS games, sum(actual) AS fpts, sum(actual) / count(actual) AS avg
  FROM {p}valued GROUP BY ALL)
"""


RANKS = """
season_ranks AS (SELECT *, CAST(row_number() OVER (PARTITION BY year, pos ORDER BY round(war, 9) DESC, player, team)
         AS INTEGER) AS rank FROM seasons),
curve AS (SELECT pos, rank, avg(war) AS war FROM season_ranks WHERE rank <= 250 GROUP BY ALL),
spine AS (SELECT pos, CAST(rank AS INTEGER) AS rank FROM (SELECT unnest(range(1, 251)) AS rank)
         CROSS JOIN (VALUES ('QB'), ('RB'), ('WR'), ('TE')) AS p(pos))
"""


def history(cfg=fx.WEEKLY_LEAGUE, upto: str = "ranks") -> str:
    steps = [WEEKLY, _elig(cfg), _ranked(cfg), _model(cfg), _seasons(cfg), RANKS]
    last = {"elig": 2, "ranked": 3, "model": 4, "seasons": 5, "ranks": 6}[upto]
    return "WITH " + ",".join(steps[:last])


SEASON_SELECT = f"year, player, team, pos, {_r('war', 'flex_war', 'superflex_war')}, games, {_r('fpts', 'avg')}"


def _duplicates() -> str:
    ties = ", ".join(("id", *fx.DUPLICATE_ORDER))
    rows = f"""
items AS (
  SELECT CAST(l_partkey AS VARCHAR) AS player, p_brand AS team, {_case("p_type", fx.PART_POSITIONS)} AS pos,
         CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS week, l_quantity AS rec,
         l_extendedprice AS yds, l_discount * 10 AS ints, l_tax * 10 AS fl, {", ".join(fx.DUPLICATE_ORDER)}
  FROM lineitem JOIN part ON l_partkey = p_partkey)
"""
    last = f"""
kept AS (SELECT * FROM elig QUALIFY row_number() OVER (PARTITION BY year, player, team, pos, week
         ORDER BY {", ".join(c + " DESC" for c in fx.DUPLICATE_ORDER)}) = 1)
"""
    cfg = fx.WEEKLY_LEAGUE
    steps = [rows, _elig(cfg, "items"), _ranked(cfg, ties), _model(cfg), last, _seasons(cfg, "kept")]
    return "WITH " + ",".join(steps) + f"SELECT {SEASON_SELECT} FROM seasons"


# Spelt out, so that the labels are checked and not only repeated.
SWEEP_LABELS = {
    "base": "12 teams / 1QB / 2RB / 2WR / 1TE / 1 Flex - Half PPR - 12 weeks",
    "small": "8 teams / 1QB / 2RB / 2WR / 1TE / 1 Flex / 1 SuperFlex - Half PPR - 10 weeks",
    "premium": "12 teams / 1QB / 2RB / 3WR / 1TE / 1 Flex - PPR / TE+0.5 - 12 weeks",
}


def _sweep() -> str:
    steps, parts = [WEEKLY], []
    for name, cfg in q.SWEEP.items():
        p = f"{name}_"
        steps += [_elig(cfg, "weekly", p), _ranked(cfg, p=p), _model(cfg, p), _seasons(cfg, p=p)]
        parts.append(f"SELECT '{name}' AS scenario, '{SWEEP_LABELS[name]}' AS label, {SEASON_SELECT} FROM {p}seasons")
    return "WITH " + ",".join(steps) + " UNION ALL ".join(parts)


def _events() -> str:
    cfg = fx.EVENT_LEAGUE
    elig = f"""
elig AS (
  SELECT CAST(year(ts) AS INTEGER) AS year, CAST(week(ts) AS INTEGER) AS week, CAST(user_id AS VARCHAR) AS player,
         {_case("event_type", fx.EVENT_POSITIONS)} AS pos, CAST(user_id AS VARCHAR) || '-' || ({_case("event_type", fx.EVENT_POSITIONS)}) AS id,
         round(sum(value), 4) AS fpts
  FROM events WHERE event_type IN {tuple(fx.EVENT_POSITIONS)} GROUP BY ALL)
"""
    return "WITH " + ",".join([elig, _ranked(cfg), _pool_rows(cfg)]) + (
        f"SELECT year, week, id, pool, role, {_r('fpts')} FROM pool_rows"
    )


# --- projections ------------------------------------------------------------------------------------

POOL = f"""
spend AS (SELECT o_custkey, sum(CAST(round(o_totalprice * 100) AS BIGINT)) // count(*) AS cents, count(*) AS n
          FROM orders GROUP BY 1),
pool AS (
  SELECT c_custkey AS ord, CAST(c_custkey AS VARCHAR) AS player_key, c_name AS player, n_name AS team,
         {_case("c_mktsegment", fx.SEGMENT_POSITIONS)} AS pos, CAST({fx.POOL_LEAGUE.projection_year} AS INTEGER) AS year,
         CAST(cents AS DOUBLE) / 1e6 AS avg
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey JOIN spend ON o_custkey = c_custkey
  WHERE c_mktsegment IN {tuple(fx.SEGMENT_POSITIONS)}),
market AS (SELECT CAST(o_custkey AS VARCHAR) AS player_key,
         CAST(row_number() OVER (ORDER BY n DESC, o_custkey) AS DOUBLE) AS adp FROM spend WHERE n >= 5)
"""


def _projected(cfg=fx.POOL_LEAGUE, with_history: bool = False) -> str:
    c = {pool: cfg.starters(pool) for pool in POOLS}
    slots = "CASE pos " + " ".join(f"WHEN '{x}' THEN {c[x]}" for x in POSITIONS) + " END"
    rows = []
    for pool in POOLS[:-1]:
        rank = "fr" if pool == "FLEX" else "pr"
        where = f"{rank} <= {2 * c[pool]}" + (f" AND pos = '{pool}'" if pool != "FLEX" else "")
        rows.append(f"SELECT '{pool}' AS pool, {rank} <= {c[pool]} AS top, avg FROM j2 WHERE {where}")
    spine = ", ".join(f"('{x}', {cfg.roster[x]}, {c[x]})" for x in POOLS)
    team = (
        "(SELECT avg(tavg) AS tavg, greatest(avg(tstd), 1) AS tstd FROM team)"
        if with_history
        else "(SELECT sum(avg * slots) AS tavg, greatest(sqrt(sum(std * std * slots)), 1) AS tstd FROM base)"
    )
    curve = "LEFT JOIN curve h ON h.pos = o.pos AND h.rank = o.pos_rank" if with_history else ""
    past = "h.war" if with_history else "CAST(NULL AS DOUBLE)"
    return f"""
{POOL},
j1 AS (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY avg DESC, ord) AS pr FROM pool),
j2 AS (SELECT *, CASE WHEN pr > {slots} AND pos <> 'QB' THEN
         row_number() OVER (PARTITION BY pr > {slots} AND pos <> 'QB' ORDER BY avg DESC, ord) END AS fr FROM j1),
jr AS ({" UNION ALL ".join(rows)}),
base AS (
  SELECT s.pool, s.slots, s.nominal, coalesce(avg(jr.avg) FILTER (WHERE top), 0) AS avg,
         CASE WHEN count(jr.avg) FILTER (WHERE top) <= 1 THEN greatest(0.2 * coalesce(avg(jr.avg) FILTER (WHERE top), 0), 1)
              ELSE stddev_pop(jr.avg) FILTER (WHERE top) END * (s.pool <> 'SUPERFLEX')::INT AS std,
         coalesce(avg(jr.avg) FILTER (WHERE NOT top), 0) AS replacement
  FROM (VALUES {spine}) AS s(pool, slots, nominal) LEFT JOIN jr ON jr.pool = s.pool GROUP BY s.pool, s.slots, s.nominal),
pteam AS (SELECT * FROM {team}),
pv AS (
  SELECT p.*, {_above("p.avg", "b.avg", "b.replacement")} * {cfg.weeks} AS war,
         CASE WHEN p.pos <> 'QB' THEN {_above("p.avg", "f.avg", "f.replacement")} * {cfg.weeks} END AS flex_war,
         CAST(NULL AS DOUBLE) AS superflex_war
  FROM pool p JOIN base b ON b.pool = p.pos JOIN base f ON f.pool = 'FLEX' CROSS JOIN pteam),
po AS (SELECT *, CAST(row_number() OVER (PARTITION BY pos ORDER BY round(war, 9) DESC, ord) AS INTEGER) AS pos_rank,
         CAST(row_number() OVER (ORDER BY round(war, 9) DESC, ord) AS INTEGER) AS overall_rank FROM pv),
results AS (
  SELECT o.*, o.player_key || '-' || o.pos || '-' || o.ord AS id, CAST(pos_rank AS VARCHAR) || o.pos AS pos_rank_label,
         {past} AS historical_war, o.war - {past} AS delta_vs_historical, m.adp, m.adp AS adp_rank,
         m.adp - overall_rank AS adp_discount,
         (m.adp - overall_rank) * (greatest(o.war, 0) / (SELECT greatest(max(greatest(war, 0)), 1) FROM po)) AS value
  FROM po o LEFT JOIN market m ON m.player_key = o.player_key {curve})
"""


def projected(select: str, with_history: bool = False) -> str:
    head = history() + "," if with_history else "WITH "
    return head + _projected(with_history=with_history) + select


TIERS = """
tline AS MATERIALIZED (
  SELECT v, count(*) AS n, round(v * 1000000000::DOUBLE)::BIGINT::HUGEINT * count(*) AS units FROM (SELECT round(war, 9) AS v FROM results) GROUP BY v),
tall AS MATERIALIZED (SELECT list(v ORDER BY v) AS s, count(*) AS n FROM (SELECT round(war, 9) AS v FROM results)),
tks AS (SELECT unnest(range(least(30, n), least(48, greatest(least(30, n), ceil(sqrt(n) * 2.5)::BIGINT), n) + 1)) AS k, s, n FROM tall),
tstart AS (
  SELECT k, list_transform(range(k), lambda i: s[least(n - 1, floor((i::DOUBLE + 0.5::DOUBLE) / k * n)::BIGINT) + 1]) AS cs FROM tks),
tmove AS (
  SELECT 0 AS round, k, cs FROM tstart
  UNION ALL
  SELECT round + 1, k, list_transform(range(1, k + 1), lambda i: coalesce(means[i], cs[i]))
  FROM (
    SELECT round, k, cs, map_from_entries(list((cl, mean))) AS means
    FROM (
      SELECT round, k, cs, list_position(list_transform(cs, lambda c: abs(v - c)), list_min(list_transform(cs, lambda c: abs(v - c)))) AS cl,
             sum(units)::DOUBLE / sum(n)::DOUBLE / 1000000000::DOUBLE AS mean
      FROM tmove, tline WHERE round < 50 GROUP BY ALL)
    GROUP BY ALL)),
tmember AS MATERIALIZED (
  SELECT k, cs, v, n, list_position(list_transform(cs, lambda c: abs(v - c)), list_min(list_transform(cs, lambda c: abs(v - c)))) AS cl
  FROM tmove, tline WHERE round = 50),
tsize AS (SELECT k, cl, sum(n) AS size FROM tmember GROUP BY ALL),
tfar AS (
  SELECT a.k, a.v, a.n, a.cl, b.cl AS other, sum(abs(a.v - b.v) * b.n) AS s, sum(b.n) AS m
  FROM tmember a JOIN tmember b ON a.k = b.k GROUP BY ALL),
tab AS (
  SELECT k, v, n, max(s / nullif(m - 1, 0)) FILTER (WHERE cl = other) AS a, min(s / m) FILTER (WHERE cl <> other) AS b FROM tfar GROUP BY k, v, n),
tscore AS (
  SELECT k, CASE WHEN min(least) < 2 OR min(filled) < 2 THEN -1 ELSE round(sum(n * (b - a) / greatest(a, b, 0.000001::DOUBLE)) / sum(n), 10) END AS score
  FROM tab JOIN (SELECT k, min(size) AS least, count(*) AS filled FROM tsize GROUP BY k) USING (k) GROUP BY k),
tbest AS (SELECT k FROM tscore ORDER BY score DESC, k LIMIT 1),
ttier AS (
  SELECT cl, row_number() OVER (ORDER BY c DESC, cl) AS tier
  FROM (SELECT unnest(cs) AS c, unnest(range(1, k + 1)) AS cl FROM (SELECT DISTINCT k, cs FROM tmember JOIN tbest USING (k)))),
tused AS (SELECT count(DISTINCT cl) AS used FROM tmember JOIN tbest USING (k)),
tiered AS (
  SELECT r.*, CAST(CASE WHEN n.n < 4 THEN 1
                        WHEN used < least(30, n.n) THEN least(least(30, n.n), floor((overall_rank - 1)::DOUBLE / n.n * least(30, n.n)) + 1)
                        ELSE tier END AS INTEGER) AS tier
  FROM results r CROSS JOIN (SELECT n FROM tall) n CROSS JOIN tused
  JOIN (SELECT v, cl FROM tmember JOIN tbest USING (k)) m ON m.v = round(r.war, 9) JOIN ttier USING (cl))
"""


def tiered(select: str, with_history: bool = False) -> str:
    """As ``projected``, with the results' tiers found by rounds of k-means, silhouettes from all pairs."""
    return projected(", " + TIERS + select, with_history).replace("WITH ", "WITH RECURSIVE ", 1)


def _fixed_silhouettes() -> str:
    """Silhouettes of fixed centers, from all pairs."""
    parts = []
    for k, centers in q.FIXED_CENTERS.items():
        rows = ", ".join(f"({i}, {c * 10}::DOUBLE)" for i, c in enumerate(centers))
        parts.append(f"SELECT {k} AS k, i, c FROM (VALUES {rows}) AS t(i, c)")
    return f"""
WITH {POOL},
centers AS ({" UNION ALL ".join(parts)}),
member AS (SELECT k, ord, avg AS v, arg_min(i, (abs(avg - c), i)) AS cl FROM pool CROSS JOIN centers GROUP BY ALL),
far AS (SELECT a.k, a.ord, a.cl, b.cl AS other, sum(abs(a.v - b.v)) AS s, count(*) AS n
        FROM member a JOIN member b ON a.k = b.k GROUP BY ALL),
ab AS (SELECT k, ord, sum(s) FILTER (WHERE cl = other) / nullif(max(n) FILTER (WHERE cl = other) - 1, 0) AS a,
        min(s / n) FILTER (WHERE cl <> other) AS b FROM far GROUP BY ALL),
small AS (SELECT k, min(n) AS least, count(*) AS filled
        FROM (SELECT k, cl, count(*) AS n FROM member GROUP BY ALL) GROUP BY k)
SELECT CAST(k AS INTEGER) AS k, R6[CASE WHEN max(least) < 2 OR max(filled) < 2 THEN -1
        ELSE avg((b - a) / greatest(a, b, 0.000001)) END] AS score
FROM ab JOIN small USING (k) GROUP BY k
"""


# --- text fixtures ----------------------------------------------------------------------------------


def _source_text() -> str:
    team = "[" + ", ".join(f"'{t}'" for t in fx.TEXT_TEAMS) + f"][p_size % {len(fx.TEXT_TEAMS)} + 1]"
    return f"""
src AS (
  SELECT p_partkey, p_size, p_name, {_case("p_type", fx.PART_POSITIONS)} AS pos, p_partkey % 5 AS layout, {team} AS code,
         q, CAST(p_size % 10 AS DOUBLE) / 10 AS tenth
  FROM part LEFT JOIN (SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY 1)
       ON l_partkey = p_partkey),
named AS (
  SELECT *, CASE WHEN layout = 1 THEN p_name || ' II' ELSE p_name END AS player,
         CASE WHEN layout = 4 THEN '' ELSE code END AS team,
         CASE WHEN layout = 4 THEN CAST(q AS DOUBLE) ELSE q + tenth END AS main,
         CASE WHEN layout <> 4 THEN q + 20 + tenth END AS high, CASE WHEN layout <> 4 THEN q - 5 + tenth END AS low
  FROM src)
"""


def _html(select: str) -> str:
    """Cells of the stat pages. A row with a table in its third cell has that table's cell as its fourth, and its two rows after it."""
    return f"""WITH {WEEKLY},
outer_rows AS (
  SELECT player, year, week, CAST(row_number() OVER w - 1 + 2 * (count(*) FILTER (WHERE week % 3 = 0) OVER w - (week % 3 = 0)::INT) AS INTEGER) AS row,
         CAST(week AS VARCHAR) AS a, CAST(CAST(rec AS BIGINT) AS VARCHAR) AS b,
         CASE WHEN week % 3 = 0 THEN 'a & bnin' ELSE 'a &b' END AS c, CASE WHEN week % 3 = 0 THEN 'in' ELSE CAST(round(ints, 1) AS VARCHAR) END AS d
  FROM weekly WHERE pos IN {POSITIONS} WINDOW w AS (PARTITION BY player, year ORDER BY week ROWS UNBOUNDED PRECEDING)),
rows AS (
  SELECT player, year, row, a, b, c, d FROM outer_rows
  UNION ALL SELECT player, year, row + 2, 'in', NULL, NULL, NULL FROM outer_rows WHERE week % 3 = 0)
{select}"""


def _letters(key: str) -> str:
    return f"translate(CAST({key} AS VARCHAR), '0123456789', 'abcdefghij')"


def _names() -> str:
    """Text order by its three levels: letters without accents and case, accents, case with small letters first."""
    levels = ("strip_accents(lower(t))", "lower(t)", "regexp_replace(regexp_replace(t, '[A-ZÉ]', '1', 'g'), '[^1]', '0', 'g')")
    up, down = ", ".join(levels), ", ".join(f"{level} DESC" for level in levels)
    return f"""
WITH accented AS (SELECT *, CASE WHEN p_size % 5 = 0 THEN replace(p_name, 'e', 'é') ELSE p_name END AS a FROM part),
cased AS (
  SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN array_to_string(list_transform(string_split(a, ' '), lambda w: upper(w[1]) || w[2:]), ' ')
                                    WHEN 1 THEN upper(a) ELSE a END AS c FROM accented),
named AS (SELECT p_partkey, CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_partkey % 89 = 0 THEN '' ELSE c END AS name FROM cased),
texts AS (SELECT *, coalesce(name, '') AS t FROM named)
SELECT p_partkey, name, CAST(row_number() OVER (ORDER BY {up}, p_partkey) AS INTEGER) AS place,
       CAST(row_number() OVER (ORDER BY {down}, p_partkey) AS INTEGER) AS place_down FROM texts
"""


def _pages_history() -> str:
    team = "[" + ", ".join(f"'{t}'" for t in fx.TEXT_TEAMS) + f"][CAST(player AS INTEGER) % {len(fx.TEXT_TEAMS)} + 1]"
    yds = lambda *positions: f"CASE WHEN pos IN {positions} THEN floor(yds) END" if len(positions) > 1 else f"CASE WHEN pos = '{positions[0]}' THEN floor(yds) END"
    is_period = lambda p: f"(year = {p[0]} AND week = {p[1]} AND pos = '{p[2]}')"
    bad, unnamed = is_period(fx.BAD_PERIOD), is_period(fx.UNNAMED_PERIOD)
    return f"""WITH {WEEKLY},
named AS (SELECT * FROM weekly WHERE pos IN {POSITIONS})
SELECT year, week, pos, CASE WHEN {bad} THEN 'second' ELSE 'first' END AS run, 'Part ' || player AS player, {team} AS team,
       {yds("QB")} AS passingyds, {yds("RB")} AS rushingyds, {yds("WR", "TE")} AS receivingyds,
       floor(rec) AS rec, CASE WHEN pos = 'QB' THEN R6[round(ints, 1)] END AS ints, CAST(NULL AS DOUBLE) AS fl, 1.0::DOUBLE AS g, CAST(NULL AS VARCHAR) AS problem, CAST(NULL AS BIGINT) AS pages
FROM named WHERE NOT {unnamed}
UNION ALL
SELECT year, week, pos, run, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, problem, count(DISTINCT CAST(player AS INTEGER) // 1000) FROM (
  SELECT *, 'first' AS run, 'no stat table' AS problem FROM named WHERE {bad} AND CAST(player AS INTEGER) < 1000
  UNION ALL SELECT *, unnest(['first', 'second']), 'no player column' FROM named WHERE {unnamed})
GROUP BY year, week, pos, run, problem
"""


SEEN = "year BETWEEN {} AND {}"


def _trend(aligned: bool) -> str:
    x = "row_number() OVER (PARTITION BY series ORDER BY year, player, team, pos)" if aligned else "year"
    tokens = ", ".join(f"({i}, '{t.split(':')[0].strip()}', {int((t.split(':') + ['0'])[1])})" for i, t in enumerate(q.TREND_TOKENS.split(",")))
    return history(upto="seasons") + f"""
SELECT CAST(series AS INTEGER) AS series, player, pos, year, CAST({x} AS INTEGER) AS x, R6[war] AS y
FROM seasons JOIN (VALUES {tokens}) AS t(series, name, since) ON player = name AND (since = 0 OR year >= since)
WHERE {SEEN.format(1996, 2001)}
"""


def _grid() -> str:
    weeks = range(1, fx.WEEKLY_LEAGUE.weeks + 1)
    cell = lambda v: ", ".join(f"max(R6[{v}]) FILTER (WHERE week = {w} AND actual IS NOT NULL) AS w{w}" for w in weeks)
    return history() + f""",
chosen AS (SELECT DISTINCT player, pos FROM season_ranks WHERE rank = 1),
newest AS (SELECT s.* FROM seasons s JOIN chosen USING (player, pos)
           QUALIFY row_number() OVER (PARTITION BY player, pos ORDER BY year DESC, team) = 1),
cells AS (SELECT v.* FROM valued v JOIN newest n ON v.player = n.player AND v.pos = n.pos AND v.year = n.year AND v.team = n.team)
SELECT player AS player_key, pos, year, team, 'war' AS metric, {cell("w_war")} FROM cells GROUP BY player, pos, year, team
UNION ALL
SELECT player, pos, year, team, 'fpts', {cell("actual")} FROM cells GROUP BY player, pos, year, team
"""


def build() -> dict[str, str]:
    return {name: _outputs(sql) for name, sql in _templates().items()}


def _templates() -> dict[str, str]:
    sf = fx.SUPERFLEX_LEAGUE
    role_columns = f"year, week, id, pool, role, {_r('fpts')}"
    value_columns = f"id, pos, {_r('avg', 'war', 'flex_war', 'superflex_war')}, pos_rank_label, overall_rank"
    metrics = ("war", "fpts", "avg", "flex_war", "superflex_war")
    return {
        "score_weekly": history(upto="elig") + f"SELECT year, week, id, team, pos, {_r('fpts')} FROM elig",
        "position_roles": history(upto="model") + f"SELECT {role_columns} FROM pool_rows WHERE pool IN {POSITIONS}",
        "flex_roles": history(sf, "model") + f"SELECT {role_columns} FROM pool_rows WHERE pool NOT IN {POSITIONS}",
        "flex_roles_events": _events(),
        "pool_stats_by_year": history(sf, "model")
        + f"SELECT year, pool, {_r('avg', 'std', 'replacement')}, CAST(n AS INTEGER) AS n_actual, "
        "CAST(nominal AS INTEGER) AS n_nominal FROM stats",
        "team_by_year": history(upto="model")
        + "SELECT year, R6[tavg] AS team_avg, R6[tstd] AS team_std FROM team",
        "team_mean": history(upto="model")
        + "SELECT R6[avg(tavg)] AS team_avg, R6[avg(tstd)] AS team_std FROM team",
        "season_value": history(upto="seasons") + f"SELECT {SEASON_SELECT} FROM seasons",
        "season_value_superflex": history(sf, "seasons") + f"SELECT {SEASON_SELECT} FROM seasons",
        "season_value_duplicates": _duplicates(),
        "csv_season_value": _duplicates(),
        "season_weeks_array": history(upto="seasons")
        + "SELECT year, player, team, pos, CAST(week AS INTEGER) AS week, R6[actual] AS fpts, "
        "R6[w_war] AS war FROM valued WHERE actual IS NOT NULL",
        "season_rank": history() + f"SELECT year, pos, rank, player, team, {_r('war')} FROM season_ranks",
        "rank_curve_long": history()
        + "SELECT pos, rank, R6[war] AS war FROM spine LEFT JOIN curve USING (pos, rank)",
        "rank_curve_wide": history()
        + "SELECT rank, "
        + ", ".join(f"max(R6[war]) FILTER (WHERE pos = '{x}') AS {x.lower()}_war" for x in POSITIONS)
        + " FROM spine LEFT JOIN curve USING (pos, rank) GROUP BY rank",
        "scenario_sweep": _sweep(),
        "projected_pool": f"WITH {POOL} SELECT player_key || '-' || pos || '-' || ord AS id, player, team, pos, year, {_r('avg')} FROM pool",
        "projected_baselines": projected(
            f"SELECT pool, {_r('avg', 'std', 'replacement')}, CAST(nominal AS INTEGER) AS n_nominal, "
            "R6[tavg] AS team_avg, R6[tstd] AS team_std FROM base CROSS JOIN pteam"
        ),
        "projected_value": projected(f"SELECT {value_columns} FROM results"),
        "market_order": f"WITH {POOL} SELECT player_key, adp, adp AS adp_rank FROM market",
        "value_vs_market": projected(f"SELECT id, overall_rank, {_r('adp', 'adp_rank', 'adp_discount', 'value')} FROM results"),
        "delta_vs_history": projected(
            f"SELECT id, pos, pos_rank, {_r('war', 'historical_war', 'delta_vs_historical')} FROM results", True
        ),
        "tiers_rank_balanced": f"""WITH {POOL},
            o AS (SELECT *, row_number() OVER (ORDER BY avg DESC, ord) AS place, count(*) OVER () AS n FROM pool)
            SELECT player_key || '-' || pos || '-' || ord AS id, CAST(place AS INTEGER) AS overall_rank,
                   CAST(least({q.BALANCED_TIERS}, floor((place - 1)::DOUBLE / n * {q.BALANCED_TIERS}) + 1) AS INTEGER) AS tier FROM o""",
        "tiers_silhouette_fixed": _fixed_silhouettes(),
        "tiers_kmeans": tiered("SELECT id, pos, overall_rank, R6[war] AS war, tier FROM tiered"),
        "names_by_locale": _names(),
        "visible_top": projected(
            f"""SELECT id, player, team, pos, overall_rank, {_r('value')} FROM (
                SELECT * FROM results WHERE pos IN ('QB', 'TE') AND contains(lower(player || ' ' || team), 'nation_1')
                ORDER BY value DESC NULLS FIRST, overall_rank LIMIT 400)"""
        ),
        "ranked_projection_table": tiered(
            f"""SELECT overall_rank, player, team, pos, pos_rank_label, {_r('war', 'flex_war', 'superflex_war')},
                {_r('historical_war', 'delta_vs_historical', 'adp', 'value')}, tier FROM tiered ORDER BY overall_rank LIMIT 400""",
            True,
        ),
        "summary_cards": projected(
            "SELECT count(*) AS player_count, arg_min(player, overall_rank) AS top_war_player, "
            "R6[max(war)] AS top_war, "
            "arg_max(player, (round(value, 9), -overall_rank)) FILTER (WHERE value IS NOT NULL) AS top_value_player, "
            "R6[max(value)] AS top_value, "
            + ", ".join(f"(SELECT R6[replacement] FROM base WHERE pool = '{x}') AS {x.lower()}_replacement" for x in POSITIONS)
            + ", 'projection' AS team_source FROM results"
        ),
        "metric_vs_market": projected(
            "SELECT pos, player, R6[value] AS x, R6[coalesce(adp, overall_rank)] AS y FROM results"
        ),
        "metric_vs_market_fallback": projected(
            "SELECT pos, player, R6[war] AS x, R6[coalesce(adp, overall_rank)] AS y FROM results"
        ),
        "curve_series": history()
        + "SELECT pos, rank, R6[war] AS war FROM spine LEFT JOIN curve USING (pos, rank) WHERE pos IN ('RB', 'WR')",
        "rank_trend": history(sf)
        + " UNION ALL ".join(
            f"SELECT pos, year, player, '{m}' AS metric, R6[{m}] AS value FROM season_ranks "
            f"WHERE rank = {q.TREND_RANK} AND {SEEN.format(1996, 2000)}"
            for m in metrics
        ),
        "entity_trend_calendar": _trend(False),
        "entity_trend_aligned": _trend(True),
        "entity_trend_default": history(upto="seasons")
        + f""", shown AS (SELECT * FROM seasons WHERE {SEEN.format(1996, 2000)}),
            best AS (SELECT player, pos FROM shown WHERE year = (SELECT max(year) FROM shown)
                     ORDER BY round(war, 9) DESC, player, team LIMIT 6)
            SELECT player AS player_key, player, pos, year, CAST(row_number() OVER (PARTITION BY player, pos
                   ORDER BY year, player, team, pos) AS INTEGER) AS x, R6[fpts] AS y
            FROM shown SEMI JOIN best USING (player, pos)""",
        "entity_season_card": history()
        + f"SELECT {SEASON_SELECT} FROM seasons SEMI JOIN (SELECT player, pos FROM season_ranks WHERE rank = 1) USING (player, pos)",
        "entity_week_grid": _grid(),
        "missing_periods_grid": f"""WITH {WEEKLY}
            SELECT CAST(year AS INTEGER) AS year, CAST(week AS INTEGER) AS week, pos
            FROM (SELECT unnest(range(1995, 2002)) AS year) CROSS JOIN (SELECT unnest(range(1, 18)) AS week)
            CROSS JOIN (VALUES ('QB'), ('RB'), ('WR'), ('TE')) AS p(pos)
            ANTI JOIN weekly USING (year, week, pos)""",
        "union_by_position": f"""WITH {WEEKLY}
            SELECT player AS "Player", pos AS "Pos", year AS "Year", week AS "Week",
                   CASE WHEN pos IN ('QB', 'TE') THEN R6[ints] END AS "INTS",
                   CASE WHEN pos IN ('WR', 'TE', 'RB') THEN R6[rec] END AS "REC",
                   CASE WHEN pos IN ('WR', 'TE') THEN R6[yds] END AS "ReceivingYDS",
                   CASE WHEN pos = 'TE' THEN R6[fl] END AS "FL", 'ppr' AS scoring
            FROM weekly WHERE pos IN ('QB', 'RB', 'WR', 'TE') AND player NOT IN ('7', '11')""",
        "split_entity_text": f"""WITH {_source_text()}
            SELECT p_partkey, player, team,
                   CASE WHEN layout = 1 AND length(code) = 2 THEN p_name || ' I' ELSE player END AS bare_player,
                   CASE WHEN layout = 1 AND length(code) = 2 THEN 'I' || code ELSE team END AS bare_team FROM named""",
        "split_number_text": f"WITH {_source_text()} SELECT p_partkey, main, high, low FROM named",
        "html_table_cells": _html(
            " UNION ALL ".join(
                f"SELECT player, year, row, {i} AS col, '{h}' AS header, {v} AS value FROM rows WHERE {v} IS NOT NULL"
                for i, (h, v) in enumerate((("Week", "a"), ("QTY", "b"), ("Column", "c"), ("QTY_1", "d")))
            )
        ),
        "html_table_wide": _html(
            'SELECT player, year, row, a AS "Week", b AS "QTY", c AS "Column", d AS "QTY_1", '
            "CAST(NULL AS VARCHAR) AS absent FROM rows"
        ),
        "backfill_from_pages": _pages_history(),
        "market_from_pages": f"""WITH {POOL}
            SELECT CAST(2026 AS INTEGER) AS year, 'Customer ' || {_letters('player_key')} AS player,
                   [{', '.join(map(repr, fx.TEXT_TEAMS))}][CAST(player_key AS INTEGER) % {len(fx.TEXT_TEAMS)} + 1] AS team,
                   adp AS adp_rank, 'RB12' AS pos, adp + 0.5 AS adp FROM market""",
        "projections_from_pages": f"""WITH {_source_text()},
            paged AS (
              SELECT *, p_partkey // 500 AS page, CAST(row_number() OVER (PARTITION BY pos, p_partkey // 500 ORDER BY p_partkey) - 1 AS INTEGER) AS row
              FROM named WHERE pos IN {POSITIONS})
            SELECT CAST(2026 AS INTEGER) AS "Year", player AS "Player", team AS "Team", pos AS "Pos", page, row,
                   CASE WHEN pos = 'QB' THEN main END AS passingyds, main AS rushingyds,
                   CASE WHEN pos <> 'QB' THEN high END AS receivingyds_high, CASE WHEN pos = 'QB' THEN low END AS passingtd_low,
                   CASE WHEN pos = 'RB' THEN main END AS rushingtd, CASE WHEN pos IN ('WR', 'TE') THEN main END AS receivingtd,
                   main AS fl, high AS fl_high
            FROM paged WHERE player NOT IN ('red widget', 'hot ring')""",
        "named_pool_market": f"""WITH {POOL}
            SELECT 'customer' || {_letters('ord')} || '-' || pos || '-' || ord AS id, 'customer' || {_letters('ord')} AS player_key,
                   'CUSTOMER-' || {_letters('ord')} || ' ' || ord AS player, pos, R6[avg * 17] AS fpts, R6[avg * 17 / 18] AS avg,
                   R6[(avg * 17 + 17) / 18] AS avg_high, R6[(avg * 17 - 8.5::DOUBLE) / 18] AS avg_low, adp + 0.5 AS adp, adp AS adp_rank
            FROM pool LEFT JOIN market ON market.player_key = pool.player_key""",
        "ingest_projections": f"""WITH {_source_text()}
            SELECT CAST(2026 AS INTEGER) AS "Year", player AS "Player", team AS "Team", pos AS "Pos", CAST(count(*) AS INTEGER) AS n,
                   CASE WHEN pos = 'QB' THEN round(sum(main), 4) + 0.0 END AS passingyds,
                   CASE WHEN pos = 'QB' THEN round(sum(high), 4) + 0.0 END AS rushingyds_high,
                   CASE WHEN pos = 'QB' THEN round(sum(low), 4) + 0.0 END AS passingtd_low,
                   CASE WHEN pos IN ('QB', 'TE') THEN round(sum(main), 4) + 0.0 END AS fl,
                   CASE WHEN pos IN ('RB', 'WR') THEN round(sum(main), 4) + 0.0 END AS rec,
                   CASE WHEN pos = 'RB' THEN round(sum(main), 4) + 0.0 END AS rushingtd,
                   CASE WHEN pos <> 'QB' THEN round(sum(high), 4) + 0.0 END AS receivingtd_high,
                   CASE WHEN pos IN ('WR', 'TE') THEN round(sum(main), 4) + 0.0 END AS receivingyds
            FROM named WHERE pos IN ('QB', 'RB', 'WR', 'TE') AND player NOT IN ('red widget', 'hot ring') GROUP BY player, team, pos""",
        "ingest_market": f"""WITH {_source_text()}
            SELECT CAST(2026 AS INTEGER) AS "Year", player AS "Player", team AS "Team", CAST(p_partkey AS DOUBLE) AS adp_rank,
                   pos AS "POS", CASE WHEN layout = 4 THEN main END AS "ADP" FROM named""",
        "ingest_weekly": f"""WITH {_source_text()}
            SELECT CAST(2024 AS INTEGER) AS "Year", CAST(3 AS INTEGER) AS "Week", pos AS "Pos", player AS "Player",
                   team AS "Team", CAST(q AS DOUBLE) AS "REC", CASE WHEN pos = 'QB' AND layout = 4 THEN main END AS "PassingYDS",
                   CASE WHEN pos = 'RB' THEN CAST(p_partkey AS DOUBLE) WHEN pos <> 'QB' AND layout = 4 THEN main END AS "ReceivingYDS",
                   CASE WHEN pos <> 'RB' THEN CAST(p_partkey AS DOUBLE) WHEN layout = 4 THEN main END AS "RushingYDS",
                   CAST(p_partkey AS DOUBLE) AS "row" FROM named WHERE pos IN ('QB', 'RB', 'WR', 'TE')""",
        "source_fallbacks": f"""WITH {POOL} SELECT '"' || player || '", Jr.' AS player, 'fallback' AS source, team, pos, {_r('avg')} FROM pool""",
        "manifest_merge": """WITH d AS (SELECT min(year(l_shipdate)) AS a, max(year(l_shipdate)) AS b, count(*) AS n FROM lineitem)
            SELECT * FROM (SELECT unnest([
              {'key': 'adp_scoring', 'value': 'half', 'updated_at': '2024-01-01 00:00:00'},
              {'key': 'first', 'value': a::VARCHAR, 'updated_at': '2024-03-01 10:00:00'},
              {'key': 'last', 'value': b::VARCHAR, 'updated_at': '2024-03-01 10:00:00'},
              {'key': 'rows', 'value': n::VARCHAR, 'updated_at': '2024-03-01 10:00:00'},
              {'key': 'job', 'value': 'run', 'updated_at': '2024-03-02 00:00:00'}], recursive := true) FROM d)""",
        "manifest_document": """SELECT strftime(max(l_shipdate) - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS updated_at,
            CAST(NULL AS INTEGER) AS season_year, CAST(min(year(l_shipdate)) AS INTEGER) AS historical_start_year,
            CAST(max(year(l_shipdate)) AS INTEGER) AS historical_end_year FROM lineitem""",
        "export_roundtrip": tiered(
            f"""SELECT year, overall_rank, player, team, pos, pos_rank_label AS pos_rank, tier,
                {_r('war', 'historical_war', 'delta_vs_historical', 'adp', 'adp_discount', 'value', 'avg', 'flex_war', 'superflex_war')},
                CAST(NULL AS DOUBLE) AS fpts FROM tiered""",
            True,
        ),
        "weekly_roundtrip": history(upto="elig")
        + "SELECT year, week, pos, player, team, R6[fpts + CASE WHEN year = 1996 AND week > 6 THEN 1 ELSE 0 END] "
        "AS fpts FROM elig",
        "run_log_latest": """SELECT event_type AS key, arg_max(props, (ts, props)) AS value,
            strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS updated_at FROM events GROUP BY event_type""",
    }
