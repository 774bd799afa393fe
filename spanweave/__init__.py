"""spanweave: Spark-first analytics over events, intervals and rosters.

Every operator is a function from DataFrames to DataFrames; Catalyst plans the rest.
"""
