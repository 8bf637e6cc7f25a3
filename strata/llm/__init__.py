"""Training-data operators: one module per operator, queries in ``queries``.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.  Its
functions travel to the executors by value, so that workers need numpy and
pyarrow but not this repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
