"""Credit-risk and association-graph analytics as PySpark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Workers get this package's functions inside the tasks, so the package need
# not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
