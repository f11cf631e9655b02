"""Operators of a training-data pipeline over text and web tables.

Nothing else in the library imports this subpackage. Functions that run
in Python workers are shipped by value, so workers need numpy, pyarrow
and the libraries named in the README, but not `fleetpulse` itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
