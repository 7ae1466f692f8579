"""Training-data pipeline operators (nothing else in the library imports this package).

Functions of this package travel to the executors by value, so a cluster needs
numpy and pyarrow on its workers but no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
