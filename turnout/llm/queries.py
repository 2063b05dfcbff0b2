"""Imports the operators, which register their queries."""

from turnout.llm import (  # noqa: F401
    bpe, imatch, kdtree, language, mixing, neardup, negatives, phrases, quality, secrets, simhash, urls, warc,
)
from turnout.llm.registry import QUERIES, SQL  # noqa: F401
