"""Operations of a training-data pipeline over text corpora, web pages and vectors.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames, keeps its input columns untouched unless it says so, and
writes what it needs twice to ``spark.checkpoint.dir``.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors as code, so they run on a
# cluster whose workers have no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
