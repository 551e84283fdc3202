"""Replacement-level valuation of scored entities, expressed as Spark DataFrame plans."""

from waterline.config import LeagueConfig, Roster, Scenarios, ScoringWeights

__all__ = ["LeagueConfig", "Roster", "Scenarios", "ScoringWeights"]
