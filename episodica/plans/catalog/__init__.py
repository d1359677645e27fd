"""Registered queries: each runs an operator over whole tables, most with the SQL that checks it."""

from episodica.plans.catalog.registry import ORACLE, QUERIES  # noqa: F401  (filled by the imports below)
from episodica.plans.catalog import cohort, decisions, evaluation, fits, fixed, rates, splits, training  # noqa: F401
from episodica.plans.catalog import given, inputs  # noqa: F401  (reuse queries of the others)
