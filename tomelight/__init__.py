"""Document analytics and retrieval on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from . import functions, operators, plans, sources, streaming

# Send task functions with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
