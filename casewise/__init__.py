"""casewise: tabular binary-decision analytics as Spark jobs.

Records are loaded into DataFrames, profiled, validated, split, featurised,
rebalanced, modelled, evaluated and scored -- every step is a DataFrame
expression, a Spark ML stage or a Structured Streaming query.
"""

import sys as _sys

# Functions of this package that run inside Python workers (pandas UDFs,
# cogroup tasks) are pickled by value, so executors need no installed copy of
# the package and the driver's working directory does not matter.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # older cloudpickle: ship with --py-files
    pass

from casewise.session import build_session, checkpoint_dir  # noqa: E402

__all__ = ["build_session", "checkpoint_dir"]
