"""Record archiving, file ingestion and latency measurement as Spark jobs."""

import sys

from pyspark import cloudpickle

# Arrow functions and data sources of this package travel to the executors by
# value, so a cluster needs no copy of the package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
