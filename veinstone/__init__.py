"""veinstone: a Spark-native engine for evidence tables and corpus preparation."""

__version__ = "0.1.0"
