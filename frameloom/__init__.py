"""frameloom: Spark-native curation of embedded driving frames and their texts."""

__version__ = "0.1.0"
