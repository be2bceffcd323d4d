"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  Its functions run in
executors' Python workers, so they are shipped by value: a cluster needs no
installed copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
