"""strata: layered (bronze / silver / gold) analytics tables on PySpark.

Each operator is a DataFrame -> DataFrame function built from Spark's own
expressions; thin I/O wrappers in ``strata.sources`` write the layers.
"""

__version__ = "0.1.0"
