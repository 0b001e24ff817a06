"""Spark-native preparation of tables, texts, web pages and landed API responses.

Every operator takes and returns a ``DataFrame`` or a ``Column``.  The few
Arrow UDFs are shipped by value, so executors need no installed copy.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
