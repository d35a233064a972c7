"""tessera: parameterised Spark DataFrame operators and the pipelines built from them.

Layout
------
sources/    readers (typed / header / delimited CSV, text lines, GeoJSON, Parquet) and sinks
functions/  Column -> Column expression builders and their Arrow UDF twins
operators/  DataFrame -> DataFrame relational, ranking, set, grouped and streaming helpers
plans/      end-to-end pipelines and the registry of named queries over the test tables
streaming/  intentionally empty: every job in scope is batch

Every operator takes DataFrames and returns a DataFrame; none collects rows to the driver
and none changes session settings.
"""

__all__ = ["sources", "functions", "operators", "plans"]
