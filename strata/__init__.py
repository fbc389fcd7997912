"""strata: a Spark-native medallion (Bronze -> Silver -> Gold) sales pipeline.

Layers:

- ``strata.sources``    schemas, CSV/Parquet readers and writers, landing manifest,
                        adapters from the benchmark tables to the Bronze text shape.
- ``strata.functions``  tolerant conversions and message formatting as Column expressions.
- ``strata.operators``  Silver and Gold transforms, the fused check evaluator,
                        cross-layer reconciliation and profiling operators.
- ``strata.plans``      check suites, jobs with exit codes, and the query catalog.
"""

__version__ = "0.1.0"
