"""Operators of a training-data pipeline: duplicates, decontamination,
language and quality models, mixing, sharding and chat formatting.

Nothing else in rivulet imports this subpackage; it can be removed whole.
Functions that run in Python workers are pickled by value, so executors need
only numpy, pandas and pyarrow, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
