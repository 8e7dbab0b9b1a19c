"""Operations of a training-data pipeline. Nothing else in the library imports this subpackage."""

from pyspark import cloudpickle

import loam.llm as _self

# Functions that run on executors travel with the job, so that a cluster needs no installation of this package.
cloudpickle.register_pickle_by_value(_self)
