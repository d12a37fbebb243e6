"""tessera: market-basket mining and near-duplicate text detection on Spark.

Every public operator is a DataFrame -> DataFrame function whose core runs as
Spark joins, aggregations and expressions; Python only appears inside
Arrow-batched pandas UDFs for the two per-row kernels (shingle hashing and
MinHash), which Spark partitions and schedules like any other expression.
"""

__version__ = "0.1.0"
