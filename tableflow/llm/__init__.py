"""Operators for training-data pipelines over a ``documents`` table. Nothing else imports this."""

import sys

from pyspark import cloudpickle

# the functions that run in tasks travel with them: executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
