"""Spark-native toolkit for labelled customer-ticket corpora."""
