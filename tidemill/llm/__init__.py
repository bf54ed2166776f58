"""Operators for building training corpora: filters, scans, duplicates, mixing, tokens, chat formats.

Nothing outside this folder imports it. `queries.py` lists the jobs as queries.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel with the job, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
