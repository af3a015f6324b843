"""Corpus preparation, tokenizer fitting, metrics and path selection as Spark jobs.

Every operator takes and returns DataFrames or Columns; nothing here keeps a
session of its own.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Executors need not have this package installed: functions sent to Python
# workers carry their own code.
register_pickle_by_value(sys.modules[__name__])
