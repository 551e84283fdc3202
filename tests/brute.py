"""Small plain-Python models the Spark results are compared with."""

import math
from collections import defaultdict

POSITIONS = ("QB", "RB", "WR", "TE")
SHARED = ("FLEX", "SUPERFLEX")


def erf(x):
    t = 1 / (1 + 0.3275911 * abs(x))
    total = 0.0
    for power, a in enumerate((0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429), start=1):
        total += a * t**power
    value = 1 - total * math.exp(-x * x)
    return 0.0 if x == 0 else math.copysign(value, x)


def share(score, mean, std):
    return 0.5 * (1 + erf((score - mean) / (std * math.sqrt(2))))


def mean(values):
    return sum(values) / len(values) if values else 0.0


def spread(values):
    if len(values) <= 1:
        return max(0.2 * mean(values), 1.0)
    m = mean(values)
    return math.sqrt(sum((v - m) ** 2 for v in values) / len(values))


def pools_of(rows, starters, floor):
    """{pool: (starter scores, replacement scores)} of one period's rows (id, pos, score, tie)."""
    ordered = sorted(rows, key=lambda r: (-r[2], r[3]))
    taken, out = set(), {}
    for pool in (*POSITIONS, *SHARED):
        n = starters[pool]
        if pool in POSITIONS:
            mine = [r for r in ordered if r[1] == pool]
        elif pool == "FLEX":
            mine = [r for r in ordered if r[1] != "QB" and (r[0], r[1]) not in taken]
        else:
            mine = [r for r in ordered if (r[0], r[1]) not in taken]
        low = floor if pool != "SUPERFLEX" else 0
        out[pool] = ([r[2] for r in mine[: max(n, low)]], [r[2] for r in mine[n : max(2 * n, low)]])
        if pool == "FLEX" or pool in POSITIONS:
            taken |= {(r[0], r[1]) for r in mine[:n]}
    return out


def statistics(parts):
    """{pool: (mean, std, replacement, n)} of a list of ``pools_of`` results."""
    out = {}
    for pool in (*POSITIONS, *SHARED):
        top = [v for p in parts for v in p[pool][0]]
        rest = [v for p in parts for v in p[pool][1]]
        out[pool] = (mean(top), spread(top), mean(rest), len(top))
    return out


def team(stats, slots):
    total = sum(stats[p][0] * slots[p] for p in stats)
    return total, max(math.sqrt(sum(stats[p][1] ** 2 * slots[p] for p in stats)), 1.0)


def history(rows, teams, slots, weeks):
    """rows: (player, team, pos, year, week, fpts, tie). Returns (stats by year, season values)."""
    starters = {p: slots[p] * teams for p in slots}
    years, seasons = {}, {}
    by_week = defaultdict(list)
    latest = {}
    for player, club, pos, year, week, fpts, tie in rows:
        if 1 <= week <= weeks:
            by_week[year, week].append((player, pos, fpts, (f"{player}-{pos}", tie)))
            key = (year, player, club, pos, week)
            if key not in latest or latest[key][1] < tie:
                latest[key] = (fpts, tie)
    for year in {y for y, _ in by_week}:
        stats = statistics([pools_of(v, starters, 0) for (y, _), v in by_week.items() if y == year])
        years[year] = (stats, team(stats, slots))
    grouped = defaultdict(dict)
    for (year, player, club, pos, week), (fpts, _) in latest.items():
        grouped[year, player, club, pos][week] = fpts
    for key, played in grouped.items():
        stats, (_, std) = years[key[0]]
        pos = key[3]

        def total(pool):
            base = stats[pool]
            return sum(
                share(played.get(w, stats[pos][2]), base[0], std) - share(base[2], base[0], std)
                for w in range(1, weeks + 1)
            )

        seasons[key] = (
            total(pos),
            total("FLEX") if pos != "QB" else None,
            total("SUPERFLEX") if stats["SUPERFLEX"][3] else None,
            len(played),
            sum(played.values()),
        )
    return years, seasons


def kmeans(values, k):
    """Centers by Lloyd's rounds from the quantile start, and every value's cluster."""
    line = sorted(values)
    centers = [line[min(len(line) - 1, int((i + 0.5) / k * len(line)))] for i in range(k)]
    nearest = lambda v: min(range(k), key=lambda i: (abs(v - centers[i]), i))
    member = [nearest(v) for v in values]
    for _ in range(50):
        groups = defaultdict(list)
        for v, c in zip(values, member):
            groups[c].append(v)
        centers = [mean(groups[i]) if groups[i] else centers[i] for i in range(k)]
        moved = [nearest(v) for v in values]
        if moved == member:
            break
        member = moved
    return centers, member


def silhouette(values, member):
    groups = defaultdict(list)
    for i, c in enumerate(member):
        groups[c].append(i)
    if len(groups) < 2 or min(len(g) for g in groups.values()) < 2:
        return -1.0
    scores = []
    for i, c in enumerate(member):
        gap = lambda g: mean([abs(values[i] - values[j]) for j in g if j != i])
        a = gap(groups[c])
        b = min(gap(g) for other, g in groups.items() if other != c)
        scores.append((b - a) / max(a, b, 1e-6))
    return mean(scores)


def tiers(values):
    """Tier of each value, values given in rank order."""
    n = len(values)
    if n < 4:
        return [1] * n
    low = min(30, n)
    high = min(48, max(low, math.ceil(2.5 * math.sqrt(n))), n)
    best = None
    for k in range(low, high + 1):
        centers, member = kmeans(values, k)
        score = round(silhouette(values, member), 10)
        if best is None or score > best[0]:
            best = (score, centers)
    centers = best[1]
    order = sorted(range(len(centers)), key=lambda i: -centers[i])
    tier = {c: t for t, c in enumerate(order, start=1)}
    out = [tier[min(range(len(centers)), key=lambda i: (abs(v - centers[i]), i))] for v in values]
    if len(set(out)) < low:
        out = [min(low, int(i / n * low) + 1) for i in range(n)]
    return out
