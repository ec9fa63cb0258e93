"""repolens: Spark-native analytics over software-development activity records.

Layers: ``sources`` (landed JSON / parquet / tables) -> ``plans.silver`` (clean,
classify, dedup) -> ``plans.gold`` (monthly counts, focus-vs-top-k, median gaps)
-> ``sinks`` (tables, export, upsert) with ``operators.quality`` checks.
Every operator is a ``DataFrame -> DataFrame`` function with column names as
parameters, so it runs on any table with the right columns.
"""

__version__ = "0.1.0"
