"""Issue monitoring for community posts and news, as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

from signalpost.session import build_session, checkpoint_root, work_folder

# The few functions that run in Python workers travel with their tasks, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "checkpoint_root", "work_folder"]
