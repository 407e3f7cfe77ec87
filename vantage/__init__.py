"""Viewpoint traffic analytics as Spark DataFrame jobs.

Sub-packages:
  sources    readers and writers (COCO JSON, mapping CSV, metrics JSONL, registry, file listings)
  functions  column expressions (file stems, bbox area, keyword flags, entropy terms, vectors)
  operators  DataFrame -> DataFrame operators (metrics, mapping index, insight, similarity, checks)
  plans      job entry points and the query catalog used by ``__spark_entry__``

The few Arrow/pandas task bodies (similarity blocks) live
in this package. They are pickled by value, so Python workers need not have
the package installed; on a cluster it can also be shipped with
``spark-submit --py-files`` (see ``package_zip``).
"""

import sys as _sys

try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # older cloudpickle: ship with --py-files instead
    pass

__all__ = ["session", "package_zip"]


def package_zip(out_path: str) -> str:
    """Zip this package for ``--py-files`` / ``SparkContext.addPyFile``."""
    import os
    import zipfile

    root = os.path.dirname(os.path.abspath(__file__))
    with zipfile.ZipFile(out_path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    return out_path
