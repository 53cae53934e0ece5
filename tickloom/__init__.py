"""Tick analytics as Spark DataFrame operators, for any number of keys at once."""

__version__ = "0.1.0"
