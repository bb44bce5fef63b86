"""Operators for preparing text corpora: packing, chat formatting, quality, fingerprints,
mixing, toxicity, line and near-duplicate removal, language-model scoring and URL filters.

Nothing outside this package imports it. Intermediate tables go to the shared folder that the
session names in ``spark.checkpoint.dir`` (see :mod:`obsmart.llm.storage`).
"""

import sys

from pyspark import cloudpickle

# Code for the Python workers travels with the tasks: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
