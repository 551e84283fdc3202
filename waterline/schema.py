"""Alias-tolerant column resolution.

A logical field has an ordered list of accepted headers. They are resolved once against the
frame's schema; only the fall-through on empty cells stays in the row expression.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waterline.functions.numeric import finite, to_number

# Accepted headers per logical field, in order of precedence.
ALIASES: dict[str, tuple[str, ...]] = {
    "player": ("Player", "player", "Name", "PLAYER"),
    "pos": ("Pos", "position", "POS"),
    "team": ("Team", "team", "TEAM"),
    "year": ("Year", "year"),
    "week": ("Week", "week"),
    "adp": ("ADP", "ADP AVG", "Average Draft Position"),
    "adp_rank": ("ADP Rank",),
    "avg": ("AVG", "Avg", "FPTS/G", "Fantasy Points Per Game"),
    "fpts": ("FPTS", "Fantasy Points", "fantasy_points"),
    "existing_war": ("WAR",),
    "high": ("AVG High", "FPTS High", "High"),
    "low": ("AVG Low", "FPTS Low", "Low"),
    "rec": ("REC", "Receptions", "ReceivingREC", "Receiving REC"),
    "rec_yds": ("ReceivingYDS", "Receiving YDS", "Rec YDS", "YDS", "Receiving Yards"),
    "rec_td": ("ReceivingTD", "Receiving TD", "Rec TD", "TD", "ReceivingTDS"),
    "rush_yds": ("RushingYDS", "Rushing YDS", "Rush YDS", "YDS_2", "Rushing Yards"),
    "rush_td": ("RushingTD", "Rushing TD", "Rush TD", "TD_2", "RushingTDS"),
    "pass_yds": ("PassingYDS", "Passing YDS", "Pass YDS", "YDS", "Passing Yards"),
    "pass_td": ("PassingTD", "Passing TD", "Pass TD", "PassingTDS"),
    "ints": ("INT", "INTS", "Interceptions"),
    "fl": ("FL", "Fumbles Lost", "Fumble Lost"),
    "market_player": ("Player", "player", "Name"),
    "market_text": ("Player Team (Bye)",),
    "market_adp": ("ADP", "AVG", "Average"),
    "market_rank": ("ADP Rank", "Rank"),
}
STATS = ("rec", "rec_yds", "rec_td", "rush_yds", "rush_td", "pass_yds", "pass_td", "ints", "fl")
# Headers too ambiguous to prove on their own that a row carries stats.
AMBIGUOUS_STATS = ("YDS", "TD", "YDS_2", "TD_2")


def _loose(name: str) -> str:
    return re.sub(r"[^a-z0-9]", "", name.lower())


class Fields:
    """Logical fields of one frame, as Column expressions."""

    def __init__(self, df: DataFrame):
        self._types = {f.name: f.dataType for f in df.schema.fields}
        self._loose = {_loose(name): name for name in df.columns}

    def resolve(self, names: Sequence[str]) -> list[str]:
        """Columns that serve ``names``: exact header first, then its loosened spelling."""
        found: dict[str, None] = {}
        for name in names:
            if name in self._types:
                found[name] = None
            loose = self._loose.get(_loose(name))
            if loose is not None:
                found[loose] = None
        return list(found)

    def _names(self, field: str | Sequence[str]) -> Sequence[str]:
        return ALIASES[field] if isinstance(field, str) else field

    def _col(self, name: str) -> Column:
        return F.col("`" + name.replace("`", "``") + "`")

    def _present(self, name: str) -> Column:
        col = self._col(name)
        return (col != "") if isinstance(self._types[name], T.StringType) else col.isNotNull()

    def _pick(self, field, value) -> Column | None:
        columns = self.resolve(self._names(field))
        if len(columns) == 1:
            # Nothing to fall through to, so the cell's own value will do and stays open to push-down.
            return value(columns[0])
        chain = None
        for name in columns:
            branch = (self._present(name), value(name))
            chain = F.when(*branch) if chain is None else chain.when(*branch)
        return chain

    def text(self, field, default: str | None = None) -> Column:
        """First non-empty cell among the aliases, as text."""
        def value(name: str) -> Column:
            text = self._col(name).cast("string")
            return F.nullif(text, F.lit("")) if isinstance(self._types[name], T.StringType) else text

        found = self._pick(field, value)
        fallback = F.lit(default).cast("string")
        return fallback if found is None else F.coalesce(found, fallback)

    def number(self, field, default: float | None = None) -> Column:
        """First non-empty cell among the aliases, read as a number ("-" wins, then reads as missing)."""

        def value(name: str) -> Column:
            if isinstance(self._types[name], T.StringType):
                return to_number(self._col(name))
            number = self._col(name).cast("double")
            return number if isinstance(self._types[name], T.IntegralType) else finite(number)

        found = self._pick(field, value)
        fallback = F.lit(default).cast("double")
        return fallback if found is None else F.coalesce(found, fallback)

    def whole(self, field) -> Column:
        """``number`` if it is whole and an integer holds it, else NULL; no cell can fail the job.

        A lone column of at most four bytes stays as it is, so filters on it prune partitions.
        """
        columns = self.resolve(self._names(field))
        if len(columns) == 1 and isinstance(self._types[columns[0]], T.IntegralType):
            return self._col(columns[0]).try_cast("int")
        number = self.number(field)
        whole = F.when(number == F.floor(number), number).try_cast("int")
        if len(columns) == 1 and isinstance(self._types[columns[0]], T.StringType):
            # Most cells are a few digits, which need no reading as a decimal.
            cell = self._col(columns[0])
            whole = F.coalesce(F.when(cell.rlike(r"^\d{1,9}$"), cell.try_cast("int")), whole)
        return whole

    def any_present(self, names: Sequence[str]) -> Column:
        columns = self.resolve(names)
        if not columns:
            return F.lit(False)
        return F.coalesce(*[F.when(self._present(n), True) for n in columns], F.lit(False))

    def has(self, field) -> bool:
        return bool(self.resolve(self._names(field)))


def stat_headers() -> list[str]:
    """Headers whose presence proves that a row carries scoring stats."""
    return [n for stat in STATS for n in ALIASES[stat] if n not in AMBIGUOUS_STATS]
