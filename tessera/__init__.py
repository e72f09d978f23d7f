"""Tessera: a PySpark-native engine for inventories, evidence retrieval and linked records."""

__version__ = "0.1.0"
