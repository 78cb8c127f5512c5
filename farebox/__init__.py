"""farebox: trip analytics on Spark DataFrames.

Layers: ``sources`` (typed loads, sinks), ``functions`` (Catalyst scalar
helpers), ``operators`` (joins, filters, windows, quality checks), ``plans``
(models, marts, reports, daily job, pipeline), ``streaming`` (incremental
daily job). Every function maps DataFrames to lazy DataFrames.
"""

__version__ = "0.1.0"
