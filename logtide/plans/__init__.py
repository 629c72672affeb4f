"""Registered queries over the test tables, each with its answer in plain SQL where SQL can say it."""

from . import joins, learning, offsets, parsing, rollups, scalars, storage, streams, textsim  # noqa: F401
from .registry import oracles, queries

__all__ = ["queries", "oracles"]
