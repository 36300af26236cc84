"""Tabular data quality, feature preparation and classifier auditing on Spark.

Every operator is a function from DataFrame to DataFrame. Folders:

* ``functions``  column expressions (text cleaning, binning, rates, row digests)
* ``operators``  work on whole tables (profiling, rules, encoding, splits, models, metrics)
* ``sources``    reading and writing (tables, reports, fitted state, run log)
* ``plans``      declared schemas, end-to-end stages, registered queries and their SQL
"""
