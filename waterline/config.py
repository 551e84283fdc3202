"""League settings, validation and scenario sets.

A ``LeagueConfig`` is plain driver-side configuration. A ``Scenarios`` object holds one or more of
them and turns each setting into a Column: a literal for one config, a lookup on ``scenario``
otherwise, so the same plan serves a single league and a sweep over many.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
POSITIONS = ("QB", "RB", "WR", "TE")
FLEX_POSITIONS = ("RB", "WR", "TE")
POOLS = ("QB", "RB", "WR", "TE", "FLEX", "SUPERFLEX")
MAX_CURVE_RANK = 250
TABLE_ROWS = 400
FIRST_WEEK, LAST_WEEK = 1, 18

SCENARIO, SCORING = "scenario", "scoring"


def _whole(name: str, value, low: int) -> None:
    if isinstance(value, bool) or int(value) != value or value < low:
        raise ValueError(f"{name} must be a whole number of at least {low}, got {value!r}")


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else repr(value)


# The default weights and roster.
@dataclass(frozen=True)
class ScoringWeights:
    rec: float = 1.0
    te_premium: float = 0.0
    rec_yds: float = 0.1
    rec_td: float = 6.0
    rush_yds: float = 0.1
    rush_td: float = 6.0
    pass_yds: float = 0.04
    pass_td: float = 4.0
    ints: float = -2.0
    fl: float = -2.0

    def label(self) -> str:
        """PPR / Half PPR / Standard / "x PPR", with the tight-end premium appended."""
        named = {1.0: "PPR", 0.5: "Half PPR", 0.0: "Standard"}
        text = named.get(float(self.rec), f"{self.rec:.1f} PPR")
        return f"{text} / TE+{self.te_premium:.1f}" if self.te_premium else text


@dataclass(frozen=True)
class Roster:
    QB: int = 1
    RB: int = 2
    WR: int = 2
    TE: int = 1
    FLEX: int = 1
    SUPERFLEX: int = 0

    def __post_init__(self):
        for pool in POOLS:
            _whole(f"{pool} slots", getattr(self, pool), 0)

    def __getitem__(self, pool: str) -> int:
        return getattr(self, pool)


@dataclass(frozen=True)
class LeagueConfig:
    teams: int = 12
    weeks: int = 17
    roster: Roster = field(default_factory=Roster)
    scoring: ScoringWeights = field(default_factory=ScoringWeights)
    projection_year: int = 2026
    start_year: int = 2015

    def __post_init__(self):
        _whole("teams", self.teams, 1)
        _whole("weeks", self.weeks, FIRST_WEEK)
        if self.weeks > LAST_WEEK:
            raise ValueError(f"weeks must lie in [{FIRST_WEEK}, {LAST_WEEK}], got {self.weeks}")

    @classmethod
    def clamped(cls, weeks: float, **settings) -> "LeagueConfig":
        """Build a config from an unchecked week count, pulled into the legal range."""
        return cls(weeks=int(max(FIRST_WEEK, min(LAST_WEEK, weeks))), **settings)

    def starters(self, pool: str) -> int:
        return self.roster[pool] * self.teams

    def label(self) -> str:
        bits = [f"{self.teams} teams"] + [f"{self.roster[p]}{p}" for p in POSITIONS]
        if self.roster.FLEX:
            bits.append(f"{self.roster.FLEX} Flex")
        if self.roster.SUPERFLEX:
            bits.append(f"{self.roster.SUPERFLEX} SuperFlex")
        return f"{' / '.join(bits)} - {self.scoring.label()} - {self.weeks} weeks"


class Scenarios:
    """Named league configs evaluated together; a single config adds no column to the plan."""

    def __init__(self, configs: LeagueConfig | dict[str, LeagueConfig]):
        self.single = isinstance(configs, LeagueConfig)
        self.configs = {"": configs} if self.single else dict(configs)
        if not self.configs:
            raise ValueError("at least one league config is needed")

    @classmethod
    def of(cls, value: "Scenarios | LeagueConfig | dict[str, LeagueConfig]") -> "Scenarios":
        return value if isinstance(value, Scenarios) else cls(value)

    def __len__(self) -> int:
        return len(self.configs)

    @property
    def keys(self) -> list[str]:
        return [] if self.single else [SCENARIO]

    def values(self, pick: Callable[[LeagueConfig], float]) -> list:
        return [pick(cfg) for cfg in self.configs.values()]

    def highest(self, pick: Callable[[LeagueConfig], int]) -> int:
        return max(self.values(pick))

    def lowest(self, pick: Callable[[LeagueConfig], int]) -> int:
        return min(self.values(pick))

    def sql(self, pick: Callable[[LeagueConfig], float]) -> str:
        """The setting as SQL text: one literal when all configs agree, else looked up by scenario."""
        found = self.values(pick)
        if len(set(found)) == 1:
            return _literal(found[0])
        entries = ", ".join(f"{_literal(name)}, {_literal(pick(cfg))}" for name, cfg in self.configs.items())
        return f"element_at(map({entries}), {SCENARIO})"

    def column(self, pick: Callable[[LeagueConfig], float]) -> Column:
        return F.expr(self.sql(pick))

    @property
    def scorings(self) -> list[ScoringWeights]:
        """The distinct scorings, numbered by their place."""
        return list(dict.fromkeys(cfg.scoring for cfg in self.configs.values()))

    def expand(self, df: DataFrame) -> DataFrame:
        """Repeat each row once per scenario, of its own scoring if it has one (a generator over literals, no join)."""
        if self.single:
            return df
        names = F.array(*[F.lit(name) for name in self.configs])
        if SCORING in df.columns:
            own = [[F.lit(n) for n, cfg in self.configs.items() if cfg.scoring == w] for w in self.scorings]
            names = F.get(F.array(*[F.array(*group) for group in own]), F.col(SCORING))
        return df.select(F.explode(names).alias(SCENARIO), "*")

    def labels(self, spark) -> DataFrame:
        """One row per scenario with its roster and scoring label."""
        rows = [(name, cfg.label()) for name, cfg in self.configs.items()]
        return spark.createDataFrame(rows, f"{SCENARIO} string, label string")


SCORING_FIELDS = tuple(f.name for f in fields(ScoringWeights))
