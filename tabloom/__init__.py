"""Tabular preparation, feature, model and scoring operators as Spark DataFrame plans."""

__version__ = "0.1.0"
