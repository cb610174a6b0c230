"""Spark-native signal analytics: tabular comparisons, state diffs, text signals, gates and ledgers."""
