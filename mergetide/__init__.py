"""mergetide: record fusion on Spark.

Records of several prioritised sources are mapped onto one schema, completed with computed and unique attributes, matched against a
known population and one another, routed, and reported. Everything is declared with DataFrames and Column expressions; Arrow batches
carry the few kernels that Spark has no expression for.
"""

__version__ = "0.1.0"
