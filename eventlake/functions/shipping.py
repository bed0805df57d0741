"""Code that runs in Python workers (Arrow and pandas stages, state processors, data
source readers and writers) is pickled by value, so executors do not need the
package installed or on their path.

The whole package is registered, not single modules: a worker function may hold a
module that itself holds functions of another one."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship_by_value(module_name: str) -> None:
    """Pickle the package of ``module_name`` by value from now on."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name.partition(".")[0]])
