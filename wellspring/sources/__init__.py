"""Readers for the input tables and the survey roles derived from them."""

from wellspring.sources.parquet import Tables
from wellspring.sources import roles

__all__ = ["Tables", "roles"]
