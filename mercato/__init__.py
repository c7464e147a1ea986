"""Marketplace order analytics as plain PySpark DataFrame code."""

from mercato.config import Settings
from mercato.sources.raw import Sources, read_sources

__all__ = ["Settings", "Sources", "read_sources"]
