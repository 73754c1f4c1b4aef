"""pairsmith: training pairs for text-embedding models, built as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Ship the Arrow kernels by value, so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from pairsmith.operators.schema import PromptSchema  # noqa: E402

__all__ = ["PromptSchema"]
