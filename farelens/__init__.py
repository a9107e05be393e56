"""farelens: a Spark-native fare data-quality and KPI engine.

Layers, each a plain set of DataFrame -> DataFrame functions:

* ``farelens.sources``    raw CSV and table readers, plus the mapping of the
                          TPC-H-like test tables onto the fare model
* ``farelens.functions``  column-expression helpers (strip, parsing, rounding)
* ``farelens.operators``  row rules, cleaning and enrichment, KPIs, reports
* ``farelens.plans``      the end-to-end batch run and its sinks
"""

__version__ = "0.1.0"
