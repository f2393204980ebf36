"""tabquorum: tabular preparation and supervised-model comparison on PySpark.

Everything is DataFrame expressions and ``pyspark.ml`` estimators on a session the
caller supplies; the package sets no session configuration of its own.
"""
