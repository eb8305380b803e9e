"""postmill: mining short posts with Spark DataFrames, Spark SQL, MLlib and Structured Streaming.

Every operator is a plain function ``f(df, ...) -> DataFrame`` built from
``pyspark.sql.functions``; Catalyst plans and places the work.
"""

__version__ = "0.1.0"

# Functions of this package used inside Python UDFs are shipped by value, so executors do
# not need the package installed (on a cluster, ``--py-files`` works as well).
try:  # pragma: no cover - depends on the bundled cloudpickle
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
