"""Operators for large-scale training-data pipelines (the ten numbered ones).

Nothing else in the library imports this subpackage. Its functions run
inside Spark's Python workers, so they are pickled by value: a worker needs
numpy, pyarrow and pandas, but not this repository on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
