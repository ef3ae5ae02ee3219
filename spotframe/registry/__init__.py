"""Named queries over the driver tables."""

from . import chains, graphs, markers, preprocessing, quality, spatial, statistics  # noqa: F401
from .core import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
