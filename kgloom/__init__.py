"""Spark-native toolkit for knowledge graphs held as Parquet tables."""
