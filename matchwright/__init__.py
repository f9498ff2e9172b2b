"""matchwright: a PySpark-native product-matching engine.

Every operator is a ``DataFrame -> DataFrame`` or ``Column -> Column`` function; nothing executes until an action.
"""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel with their code, so that workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
