"""Operators for preparing training data; nothing else in the library imports them.

Their task functions travel to the workers as code, so that a cluster needs no copy of the
library on its machines.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
