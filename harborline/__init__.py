"""Operations analytics expressed as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# The few Python functions that run on executors travel with their tasks, so the
# package needs no installation there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
