"""Functions that reach executors which have no copy of the package."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle


def by_value(function: Callable) -> Callable:
    """``function``; from now on what it uses of this package travels with it."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__.partition(".")[0]])
    return function
