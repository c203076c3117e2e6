"""locusflow: vector insertion-site analytics on PySpark DataFrames.

Every public function takes DataFrames and returns DataFrames (or Columns); all samples are
processed at once, keyed by ``(sample, tag)``.
"""

import sys

from pyspark import cloudpickle

# Python-side helpers (adapter search, FASTQ/FASTA readers) are shipped inside the task closure, so
# executors need no separate installation of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
