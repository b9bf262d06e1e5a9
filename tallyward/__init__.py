"""tallyward — a Spark-native medallion pipeline for hospital billing data.

Layers (each a plain function over DataFrames):

* ``sources``   — JDBC extract, typed CSV scans, landing-JSON (bronze) scans
* ``sinks``     — landing JSON writer, table overwrite, audit / event-log appends
* ``functions`` — column expressions shared by the layers (keys, dates, money)
* ``operators`` — control (load specs, high-water mark), archive, silver, gold
* ``plans``     — the jobs: landing extract, claims/CPT to bronze, medallion refresh
* ``streaming`` — intentionally empty (the pipeline has no stream; see its docstring)
"""

from tallyward.specs import HOSPITALS, Hospital

__all__ = ["HOSPITALS", "Hospital"]
