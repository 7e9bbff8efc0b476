"""Operators bound to the test tables."""

from wearline.bindings import drift, features, modelling, monitoring, ranking, selection, storage  # noqa: F401
from wearline.bindings.registry import ORACLES, QUERIES  # noqa: F401
