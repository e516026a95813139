"""Operators for preparing text corpora: one module per operator, named queries in ``queries``."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Task functions travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
