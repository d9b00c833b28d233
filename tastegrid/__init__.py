"""Recommendation analytics as PySpark DataFrame operators."""

from tastegrid.config import DOMAINS, DomainConfig

__all__ = ["DOMAINS", "DomainConfig"]
