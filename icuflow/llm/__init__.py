"""Training-data pipeline operators; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Executors get these functions with the task, so no copy of the package has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
