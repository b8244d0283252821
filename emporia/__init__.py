"""Retail analytics as Spark DataFrame jobs: ingest, star schema, indicators, data checks and ML."""

from emporia.plans.warehouse import Warehouse

__all__ = ["Warehouse"]
