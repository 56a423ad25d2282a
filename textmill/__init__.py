"""Text-corpus preparation as Spark DataFrame jobs.

* ``sources``   - corpora, packed tables and vocabularies read and written by Spark
* ``functions`` - Column expressions (cleaning, token arrays, scores)
* ``operators`` - DataFrame in, DataFrame out
* ``plans``     - end-to-end jobs composed of the operators
"""

import sys

from pyspark import cloudpickle

# Ship the small batch functions with the tasks, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
