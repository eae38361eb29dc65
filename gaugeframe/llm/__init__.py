"""Operators for preparing training text: archives, mixing, near copies, filters, privacy.

Task code is shipped by value, so executors need numpy, pyarrow and the packages an operator
names, but not this library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
