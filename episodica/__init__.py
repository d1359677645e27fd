"""Outcome-risk analytics over longitudinal event data, as Spark DataFrame transformations."""

from episodica.roles import EpisodeRoles, FeatureSpec, ScoreRoles

__all__ = ["EpisodeRoles", "FeatureSpec", "ScoreRoles"]
