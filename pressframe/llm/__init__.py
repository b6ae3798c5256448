"""Operators of a training-data pipeline.  Nothing outside this subpackage imports it."""

import importlib
import sys

from pyspark import cloudpickle

for _name in ("bytewords", "filters"):
    importlib.import_module(f"{__name__}.{_name}")
    # Helpers that run in tasks travel with them, so executors need no copy of the package.
    cloudpickle.register_pickle_by_value(sys.modules[f"{__name__}.{_name}"])
