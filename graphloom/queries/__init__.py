"""Registered queries: each applies an operator to the tables, mostly with the same query as SQL beside it."""

from graphloom.queries import analysis, contexts, entities, graphs, linked, relational, scalars, streams, texts, web  # noqa: F401
from graphloom.queries.registry import QUERIES, SQL  # noqa: F401
