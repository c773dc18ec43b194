"""Operators of a training-data pipeline: near-duplicate search, language
labels, sharding, decontamination, page extraction, chat formatting, suffix
dedup, toxicity grades and source mixing.

Nothing else in the package imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to executors by value, so that workers need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
