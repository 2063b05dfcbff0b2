"""Registered queries over the test tables, each with its SQL where SQL can say it."""

from turnout.catalog import cleaning, counts, joins, models, ranks, sources  # noqa: F401
from turnout.catalog.registry import QUERIES, SQL  # noqa: F401
