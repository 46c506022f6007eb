"""Operators that prepare training text: near-duplicates, toxicity, secrets, quality, mixing,
decontamination, language-model scores, repeated passages and web archives.

Each module holds one operator and the thin registered query on top of it. Nothing outside this
package imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel with the tasks, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
