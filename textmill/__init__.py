"""textmill: Spark-native analytics over dated article batches and web pages.

Every operator is a plain ``DataFrame -> DataFrame`` function (or a column
expression) so that plans chain with ``DataFrame.transform`` and Catalyst sees
the whole query.  Python runs inside tasks only for HTML parsing.
"""

import sys

from pyspark import cloudpickle

from textmill.session import build_session, checkpoint_dir

# Functions that run inside tasks travel to the executors by value, so workers
# need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "checkpoint_dir"]
