"""quarry: statistical data mining and model evaluation as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel by value: executors need PySpark, NumPy,
# pandas and Arrow, but no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
