"""Operators of a training-data pipeline (packing, formatting, tokenization, scoring,
fingerprints, language ID, near-duplicates, quality rules).

Nothing outside this package imports it.  Its functions are pickled by value,
so executors need no copy of the repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
