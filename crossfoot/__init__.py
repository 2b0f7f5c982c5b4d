"""Spark-native data-reliability operators: every operator takes and returns DataFrames."""
