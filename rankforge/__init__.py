"""rankforge: ranking analytics on Spark DataFrames.

Tables of entities measured across fields (institutions across
disciplines, suppliers across part types, ...) are read, cleaned,
loaded, ranked, profiled, clustered and used for rank prediction.
Every operator takes and returns DataFrames and stays a declarative
Spark plan; only small, bounded results (k centres, quantile bounds,
model coefficients) ever reach the driver.
"""

__version__ = "0.1.0"
