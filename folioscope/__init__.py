"""Folioscope: document curation and text analytics as PySpark DataFrame operators."""

from __future__ import annotations

import os


def reach_workers() -> None:
    """Lets Python workers on this machine import the package, wherever the driver was started. A cluster gets it by --py-files."""
    from pyspark import SparkContext

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    places = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in places:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *places])  # for a session that starts later
    if (context := SparkContext._active_spark_context) is not None:
        context.environment["PYTHONPATH"] = os.environ["PYTHONPATH"]
