"""veritab: Spark-native data-quality, feature, profiling, drift and model-evaluation operators.

Every operator takes DataFrames plus column names and returns a lazy DataFrame built from
built-in Spark SQL / ML primitives, so Catalyst plans the work and it scales with the cluster.
"""

__version__ = "0.1.0"
