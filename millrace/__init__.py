"""Stream and dataset analytics as Spark DataFrame jobs.

Every function takes DataFrames (or a caller-supplied session) and returns
DataFrames.  Nothing here creates a session or sets a master.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in tasks travel with the job, so that executors need not
# have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
