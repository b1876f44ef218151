"""Operations of a large training-data pipeline. Nothing else in the package imports this one."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the plan, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
