"""Spark-native operators for spatially located count matrices."""

import sys

from pyspark import cloudpickle

from .dataset import SpatialDataset

__all__ = ["SpatialDataset"]

# Helper functions travel to the executors by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
