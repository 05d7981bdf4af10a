"""papyr: a Spark-native engine for curating text corpora and question/answer records."""

__version__ = "0.1.0"
