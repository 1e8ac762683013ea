"""Training-data operators: extraction, search, packing, counts, classifiers, de-duplication, scans.

Nothing else in the library imports this subpackage; `__spark_entry__.py` adds
its queries when it is there.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so that a
# cluster needs no installed copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
