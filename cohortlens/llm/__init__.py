"""Operators of a training-data pipeline: search, language, duplicates, quality, mixing, packing, text, scores.

Nothing else in the package imports this subpackage. Every operator takes DataFrames, picks the
columns it needs by name and leaves further columns alone, whatever they are called.

Functions that run in tasks travel with the job, so executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
