"""Queries over the test tables that exercise every operator, and the SQL they are compared with."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
