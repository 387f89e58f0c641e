"""Operators of a training-data pipeline (see README, "Training-data operators").

Nothing else in the library imports this package; ``__spark_entry__.py`` adds
its queries when the package is there.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so a cluster
# needs no copy of the library on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
