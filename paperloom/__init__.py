"""paperloom: a Spark-native document analytics engine."""

__version__ = "0.1.0"
