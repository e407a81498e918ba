"""Transcript and event analytics expressed as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# Functions of this package that run in Python workers travel with the job, so that executors need no
# copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
