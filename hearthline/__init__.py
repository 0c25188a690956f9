"""hearthline: property-listing analytics as plain PySpark DataFrame functions.

Packages:

* ``sources``    tables, area batches, raw responses, keyed stores
* ``functions``  column expressions (text, JSON, vectors)
* ``operators``  ``DataFrame -> DataFrame`` steps, the same in batch and stream
* ``plans``      the steps put together: batch tasks, SQL views, vector job
* ``streaming``  one ``writeStream`` per stage, each with its own checkpoint
"""

import sys

from pyspark import cloudpickle

# Functions handed to the executors travel with the job: no executor needs this
# package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
