"""Tabular auto-analytics on Spark: one raw table in, a modelled and explained data set out."""

from tabwright.config import RunConfig, SourceSpec

__all__ = ["RunConfig", "SourceSpec"]
