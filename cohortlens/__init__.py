"""cohortlens: outcome analytics on Spark."""

import sys

from pyspark import cloudpickle

# The two Python helpers travel with the job, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
