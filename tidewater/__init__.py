"""tidewater: Spark-native analytics operators.

Functions of this package that run inside Spark tasks (the Arrow-batched pandas functions of ordered scans, streams
and hooks) are pickled by value, so executors run them without having the package installed or on their path.
"""

import sys as _sys

try:  # pragma: no cover - depends on the PySpark build
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: fall back to shipping the package with addPyFile
    pass
