"""loamstack: a PySpark-native engine for building and monitoring source-code and text corpora."""

__version__ = "0.1.0"
