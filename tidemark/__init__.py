"""tidemark: point-in-time account analytics as PySpark DataFrame jobs.

Every operator takes DataFrames and returns DataFrames; nothing is collected
unless its size is bounded by the schema (column names, class labels, tree
nodes), and each such place says so.
"""
