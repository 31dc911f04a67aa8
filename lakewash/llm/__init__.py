"""Operators of a large-scale training-data pipeline, and their queries.

Nothing else in the library imports this subpackage. ``QUERIES`` holds one
query for each operator, ``ORACLES`` the DuckDB SQL of those that SQL can
express.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors with the job, so that
# a cluster needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
