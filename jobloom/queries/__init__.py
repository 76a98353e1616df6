"""All registered queries."""

from jobloom.queries import employers, extraction, flows, pages, postings
from jobloom.queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "employers", "extraction", "flows", "pages", "postings"]
