"""modenorm: mode-specific normalization of very large tables on Spark.

Every operator is a function over ``pyspark.sql.DataFrame``; fitted mixture
models are small tables (one row per column and mode) that enter the plans
as literals, so scoring and encoding stay inside whole-stage codegen.
"""

import sys as _sys

from modenorm.session import checkpoint_dir, get_spark


def _ship_by_value() -> None:
    """Send this package's functions to Python workers by value.

    The grouped-map fit solver and the plug-in path run in Python workers;
    pickled by value they need no copy of the package on the executors (or a
    matching working directory).  ``--py-files`` works as well.
    """
    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(_sys.modules[__name__])
    except Exception:  # noqa: BLE001 - older cloudpickle: rely on --py-files / installed package
        pass


_ship_by_value()

__all__ = ["get_spark", "checkpoint_dir"]
__version__ = "0.1.0"
