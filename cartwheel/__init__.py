"""Purchase-history analytics and recommendation as Spark jobs."""

import sys

from pyspark import cloudpickle

from cartwheel.config import Columns, Config

# Kernels travel to the executors with the job; the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Columns", "Config"]
