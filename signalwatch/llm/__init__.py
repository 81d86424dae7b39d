"""Training-data operators: scoring, filtering, de-duplication, tokenisation and packing of corpora.

Nothing outside this subpackage imports it. Functions that run inside tasks are
shipped by value, so executors need this package's dependencies (numpy, pyarrow
and the tokenizer libraries) but not the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
