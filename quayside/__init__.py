"""Quayside: a PySpark engine for landing files and API pages as queryable tables.

Functions of this package that run inside tasks are shipped by value, so executors need
neither an installed copy nor ``--py-files``.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
