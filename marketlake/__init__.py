"""Marketplace analytics on PySpark.

Layers, bottom-up:

* ``functions``  – column expressions (parsing guards, exact rounding, text).
* ``sources``    – CSV / encoding / staging / snapshot / catalog I/O.
* ``operators``  – DataFrame -> DataFrame building blocks (quality checks,
  dedup, upsert, surrogate keys, segmentation, quantiles, statistics).
* ``plans``      – the star model, the report views and the analyses,
  i.e. whole queries composed from the operators.
* ``streaming``  – micro-batch wiring of the file loads.
"""

__version__ = "0.1.0"
