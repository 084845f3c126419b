"""Operators for large training-text pipelines.

Nothing outside this package imports it.  Functions that run inside Spark's
Python workers are pickled by value, so executors need only numpy, pyarrow and
the tokenizer files, not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
