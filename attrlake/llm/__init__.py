"""Training-data operators: decontamination, near-duplicates, exact search,
PII, chat formatting, mixing, sharding, WARC, toxicity, quality, language
identification, ranked search and Merkle manifests.

Nothing outside this folder imports it; ``__spark_entry__`` adds its queries
when the folder is present.
"""

import sys

from pyspark import cloudpickle

# Functions and small classes of this folder travel to executors by value, so
# executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
