"""Marani: a PySpark-native engine for text corpora, vocabularies and dense vectors."""

__version__ = "0.1.0"
