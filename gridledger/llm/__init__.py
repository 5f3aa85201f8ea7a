"""Operators of a training-data pipeline: sharding, mixing, extraction, near
duplicates, decontamination, fingerprints, language, URLs, token counts, WARC."""

import sys

from pyspark import cloudpickle

# The Python parts travel with the tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
