"""terrane: a PySpark-native engine for geodata tables, place search and data checks."""

__version__ = "0.1.0"
