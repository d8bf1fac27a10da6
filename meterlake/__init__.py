"""meterlake — analytics of interval electricity readings on Spark DataFrames.

Raw readings → ``operators.clean.curate`` → month-partitioned Parquet →
consumption, power-quality, health, prediction, insight and dashboard queries
(``plans``), plus incremental ingest and alert streams (``streaming``).
"""
from .rules import RULES, Rules

__all__ = ["RULES", "Rules"]
