"""Imports every module that registers queries."""

from textloom.plans import graph_queries, link_queries, release_queries, text_queries  # noqa: F401
from textloom.plans.registry import ORACLES, QUERIES  # noqa: F401
