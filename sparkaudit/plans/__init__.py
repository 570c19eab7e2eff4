"""The query catalogue: every operator on the given tables, with its SQL twin."""

from . import auditing, exploration, modelling, publishing, reviewing, scoring, validation  # noqa: F401
from .catalog import oracle_sql, queries

__all__ = ["queries", "oracle_sql"]
