"""Spark-native table loads, table changes, contract audits and report queries."""
