"""Panel analytics on Spark DataFrames: scoring, prices, weather seasons, models, evaluation."""

import sys

from pyspark import cloudpickle

# Helpers used inside tasks travel with the task, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
