"""Operators of a training-data pipeline and their registered queries."""

from . import queries as _registered  # noqa: F401
from .common import _oracles, _queries

__all__ = ["queries", "oracles"]


def queries():
    return dict(_queries)


def oracles():
    return dict(_oracles)
