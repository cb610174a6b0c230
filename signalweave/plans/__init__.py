"""Registered queries; importing this package fills the registry."""

from . import discovery, questions, relational, reviews, rules, scoring, tabular, texts, timeline  # noqa: F401
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
