"""tabsmith: tabular profiling, preparation and binary classification on Spark.

Sub-packages: ``sources`` (loaders and sinks), ``functions`` (column expressions),
``operators`` (quality, profiling, chart data, cleaning, encoding, scaling, split,
evaluation), ``plans`` (table builder, models, tuning, run log, jobs) and
``streaming`` (fitted preparation applied to streams).
"""

__version__ = "0.1.0"
