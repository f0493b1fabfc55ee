"""Property-price analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function (composable with
``df.transform``) or a Spark ML stage. Nothing is collected to the driver except
bounded results (fitted category lists, one-row scalars, small histograms).
"""

__version__ = "0.1.0"
