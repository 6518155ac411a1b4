"""folioframe: a Spark-native engine for tagged bibliographic records and text corpora."""

__version__ = "0.1.0"
