"""Operators for preparing large text corpora.

Each operator lives in its own module with a general interface over
DataFrames; ``queries`` wires them to the tables.  Functions that run in
Python workers are shipped by value, so executors need no installed copy of
this package.
"""

from pyspark import cloudpickle

import genolake

cloudpickle.register_pickle_by_value(genolake)
