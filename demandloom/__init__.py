"""Demand analytics and short-horizon sales forecasting as Spark DataFrame operators."""

__version__ = "0.1.0"
