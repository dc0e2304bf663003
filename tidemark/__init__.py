"""tidemark: a Spark-native engine for contract-governed research datasets."""

__version__ = "0.1.0"
