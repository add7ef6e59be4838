"""Operators for training-data pipelines: tokens, archives, language models, de-duplication, search and mixing.

Each module holds one operator with its own interface and the thin query that derives the registered columns
from it. Operators select the columns they need first, so further columns of any name do not disturb them.
"""
import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
