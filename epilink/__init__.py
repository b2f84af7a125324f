"""Harmonise, resolve, link and graph multi-source public-health data on Spark."""

__version__ = "0.1.0"
