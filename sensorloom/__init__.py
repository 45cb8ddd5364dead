"""Validation, alerting, retry and archiving of sensor readings on Spark."""

import sys

from pyspark import cloudpickle

# Executors get the few Python helpers along with the task, so that a job runs without
# installing this package on every node first.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
