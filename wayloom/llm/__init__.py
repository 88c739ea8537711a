"""Operators for preparing training text at corpus scale.

Nothing outside this package imports it, so the rest of the library works
without it.  ``queries.py`` holds the registered queries.
"""

import os
import sys
from pathlib import Path


def _ship_by_value_if_needed() -> None:
    """Workers import this package by name; where they could not, its functions travel by value."""
    root = str(Path(__file__).resolve().parents[2])
    on_path = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if root not in on_path and os.getcwd() != root:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value_if_needed()
