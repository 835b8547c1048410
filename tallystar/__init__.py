"""tallystar: Spark DataFrame operators for statistical-release warehouses.

The package is organised by role:

* ``functions``  Column expressions (casts, ratios, label classification, text)
* ``operators``  DataFrame-to-DataFrame steps (lookup, time series, reconcile)
* ``sources``    reading releases and report text, writing and publishing tables
* ``plans``      dimensions, facts, views, questions, measures and checks
* ``streaming``  empty on purpose, see its docstring
"""

__version__ = "0.1.0"
