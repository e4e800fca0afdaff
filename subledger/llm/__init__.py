"""Operators for large training corpora: sharding, licence recognition, toxicity, vector search, source
mixing, URL filtering, near-duplicate grouping, host quality rules, quality scoring, sequence packing, language
identification, tokenizer alignment and ranked search.

Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# The functions that run in Python workers travel with their tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
