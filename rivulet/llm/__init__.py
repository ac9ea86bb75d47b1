"""Training-data operators (op1 .. op13) and the corpus pipeline's building blocks.

Nothing outside this subpackage imports it. Functions that run inside Python
tasks are pickled by value, so executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
