"""Spark-native processing of exchange trades and candles."""
