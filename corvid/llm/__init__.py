"""Operators for large text corpora. Nothing outside this subpackage (but for
the guarded registration in ``__spark_entry__.py`` and ``corpus_pipeline.py``)
imports it.

The functions that run in tasks are shipped with them by value, so executors
need no copy of this package on their path.
"""

import corvid
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(corvid)
