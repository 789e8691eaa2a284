"""tripwell: trip analytics as Spark DataFrame jobs.

The package is layered so that each layer only builds on the ones before it:

* ``functions``  column expressions (casts, time parts, hashes, indicators)
* ``sources``    reading and writing text, CSV, Parquet, JSON and models
* ``operators``  DataFrame -> DataFrame transformations
* ``plans``      compositions: refinement, personas, training, extracts
* ``catalog``    every operator bound to the sample tables as a named query
"""
