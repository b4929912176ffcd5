"""Spark-native feature engine for hourly energy forecasting."""

__version__ = "0.1.0"
