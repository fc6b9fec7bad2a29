"""Training-data operators. Nothing else in the library imports this subpackage.

The functions that run inside tasks are pickled by value, so that executors need numpy, pyarrow
and the like, but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
