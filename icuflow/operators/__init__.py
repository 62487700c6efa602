"""DataFrame -> DataFrame operators."""

import sys

from pyspark import cloudpickle

# Executors get the functions of the fitting code with the task, so no copy of the package has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
