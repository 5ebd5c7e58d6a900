"""Outage and forecast analytics as Spark jobs: every operator takes and returns DataFrames."""

from .config import Config

__version__ = "0.2.0"

__all__ = ["Config", "__version__"]
