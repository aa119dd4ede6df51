"""Operators for training-data pipelines. Nothing else in the library imports this package."""

from pyspark import cloudpickle

import rowsmith

# Functions sent to executors carry their code along, so no executor needs the library installed.
cloudpickle.register_pickle_by_value(rowsmith)
