"""tagstream: industrial telemetry analytics on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` built from native
column expressions, so Catalyst can push filters down, prune columns and
fuse the work into whole-stage codegen.  Most operators serve both batch
(``spark.read``) and streaming (``spark.readStream``) inputs.

Layout
------
``sources``    table, text, JSON/Kafka, JDBC and literal inputs
``functions``  scalar column helpers (time, numeric, formatting)
``operators``  parse, text, aggregate, running, windows, joins, top-k,
               table maintenance and constraint checks, telemetry decode
``sinks``      file, JDBC, Kafka and console outputs
``streaming``  run-to-completion helpers, per-record stateful folds, dedupe
``plans``      bindings of the operators to the driver's test tables,
               with the matching DuckDB oracle SQL
"""

__version__ = "0.1.0"
