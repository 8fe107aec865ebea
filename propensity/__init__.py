"""propensity: lead-propensity scoring as Spark DataFrame operators.

Subpackages: ``sources`` (scans, sinks, the leads view), ``functions``
(scalar column functions), ``operators`` (cleaning, profiling, validation,
imputation, encoding, splits, metrics, curves, models, scoring),
``streaming`` (incremental scoring) and ``plans`` (registered queries with
DuckDB oracles, flows, correctness and plan checks).
"""

__version__ = "0.1.0"
