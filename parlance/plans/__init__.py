"""Registered queries over the driver's tables, and their SQL."""

from parlance.plans import edits, pages, rules, speech, tables  # noqa: F401
from parlance.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401

FLAGSHIP = "token_counts"
