"""Training-data operators: quality rules and classifiers, main-text
extraction, chat rendering, exact / near / substring de-duplication,
toxicity scoring, sequence packing and byte-pair coding.

Nothing else in the library imports this subpackage. Functions that run in
Python workers are shipped with their code (``register_pickle_by_value``), so
executors need numpy, pandas, pyarrow and, for packing, ``tokenizers``, but
not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
