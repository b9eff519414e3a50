"""cleanspark: data cleaning, deduplication and data-quality profiling as lazy Spark DataFrame operators.

Layout
------
sources/    readers (CSV/Parquet/JSON as text), null tokens, header and role normalisation, sinks, fixtures
functions/  column expressions: text, phone, email, dates, numbers, similarity
operators/  DataFrame -> DataFrame operators: cleaning, profiling, quantiles, outliers, pairs, dedup,
            anomaly forest, validation rules, metrics
plans/      composed flows (train / run / classic vs smart comparison) and the query catalogue
streaming/  the same operators on Structured Streaming sources
"""

__version__ = "0.1.0"
