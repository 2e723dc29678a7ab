"""edgegraph: graph-stream analytics as Spark DataFrame / Structured Streaming plans."""

import sys

from pyspark import cloudpickle as _cloudpickle

# Functions and classes of this package that run in Python workers (the estimator chain, the streaming
# stateful processor) are shipped by value, so executors need no copy of the package on their path.
_cloudpickle.register_pickle_by_value(sys.modules[__name__])

from edgegraph.graph import EdgeStream, SnapshotStream  # noqa: E402,F401

__version__ = "0.1.0"
