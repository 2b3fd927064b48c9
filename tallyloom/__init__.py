"""Catalogue analytics as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# Functions of this package travel with the job, so that workers need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
