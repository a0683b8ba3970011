"""Operators for large training-data pipelines (secret scans, archives, token counts,
packing, language ID, near-dedup, toxicity, decontamination, repeat removal, set joins).

Nothing else in the library imports this package.  Functions that run in Python workers
are shipped by value, so executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
