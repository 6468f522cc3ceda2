"""civicgrain: a PySpark-native analytics engine for public-records text."""

__version__ = "0.1.0"
