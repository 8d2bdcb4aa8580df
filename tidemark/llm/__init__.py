"""Operators for preparing training corpora; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Executors need no copy of this code: its functions travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
