"""Threadloom: a Spark-native analytics engine for threaded discussion archives."""
