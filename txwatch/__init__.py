"""Continuous transaction surveillance expressed as Spark DataFrame operators."""

from txwatch.params import Params

__all__ = ["Params"]
