"""Change-data lakehouse engine on Spark DataFrames: change log, current state, history, marts, checks."""
