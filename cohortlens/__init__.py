"""Peer-group outlier analytics as lazy PySpark DataFrames."""
