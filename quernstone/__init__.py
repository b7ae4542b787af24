"""quernstone: a PySpark-native engine for curated document corpora."""

__version__ = "0.1.0"
