"""corpusframe: declarative loading of speech and text corpora as Spark DataFrames."""

import sys

from pyspark import cloudpickle

# the few functions that run in Python workers travel with the job, so executors need no install
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from corpusframe.plans.layouts import load, register_layout  # noqa: E402
from corpusframe.sources.files import list_files, manifest_of, scan_manifest
from corpusframe.spec import ColumnSpec, LoadSpec  # noqa: E402

__all__ = [
    "ColumnSpec",
    "LoadSpec",
    "list_files",
    "load",
    "manifest_of",
    "register_layout",
    "scan_manifest",
]
