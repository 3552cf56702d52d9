"""Operators of a training-data pipeline: filtering, deduplication, scans, tokens, archives.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions that run in Python workers travel with the job, so executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])
