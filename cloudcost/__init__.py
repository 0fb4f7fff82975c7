"""cloudcost: multi-cloud billing analytics as Spark DataFrame jobs.

Sub-packages:

* ``sources``   - scans of raw billing exports (CUR, GCP export, Huawei JSON, CSV)
                  and dimension tables; fixture adapters over the driver tables.
* ``functions`` - column-level helpers (dates, money, classification).
* ``operators`` - DataFrame -> DataFrame building blocks (daily aggregation,
                  keyed merge, rollups, pricing, amortized cost, reports).
* ``plans``     - the user-level flows composed from operators.
* ``streaming`` - incremental (Structured Streaming) load.
"""

__all__ = ["session", "config"]
