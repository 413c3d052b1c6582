"""Operators for preparing training data at scale; each module holds one operator.

Functions of this package travel to the executors by value, so a cluster needs numpy, pyarrow and the
tokenizer libraries there, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
