"""Training-data operators: ten self-contained modules over `documents`,
`pages` and `embeddings`. Nothing outside this subpackage imports it.

Each module holds one operator with its own interface; ``queries`` derives
the registered digest queries from them.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so a job runs
# also where the package is installed on the driver alone.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
