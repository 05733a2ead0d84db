"""Corpusloom: versioned text-embedding datasets as Spark DataFrame jobs.

Every public function takes DataFrames and explicit parameters and returns a DataFrame; nothing is
executed until the caller asks for an action, except where a docstring says so.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run inside tasks travel with the task, so the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
