"""Marketplace analytics as PySpark DataFrame operators."""

from souk.schema import Tables

__all__ = ["Tables"]
