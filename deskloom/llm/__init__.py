"""Operators of a training-data pipeline over a table of documents.

Functions of this subpackage that run inside tasks travel with the job (pickled by value), so executors
need pyspark, pyarrow and numpy, but no copy of this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
