"""Order enrichment and windowed counts on Spark."""

import sys

from pyspark import cloudpickle

# Python functions of this package travel inside the job, so that executors and
# the streaming workers need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
