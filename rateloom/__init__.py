"""rateloom: Spark-native processing of price files, provider registries and nested clinical records."""

__version__ = "0.1.0"
