"""Operators for large text and embedding corpora; nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Executors may lack this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
