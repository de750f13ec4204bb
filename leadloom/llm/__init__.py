"""Operators for the preparation of training data, one module each, with their queries.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from . import queries as _all_queries  # noqa: E402,F401  (fills the registry)
from .registry import QUERIES, SQL  # noqa: E402


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
