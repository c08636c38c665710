"""strata: layered analytics (landing, bronze, silver, gold) on stock PySpark.

Every operator takes and returns DataFrames; Spark plans, shuffles and spills.
"""
