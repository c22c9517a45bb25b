"""Operators that prepare text, pages and vectors for training language models.

Nothing outside this package imports it. Each module holds one operator with a general
interface; :mod:`tarmac.llm.queries` applies them to the given tables.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
