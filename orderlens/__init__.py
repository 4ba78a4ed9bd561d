"""orderlens: a PySpark-native commerce KPI engine.

Every operator is a DataFrame -> DataFrame function expressed with the
DataFrame / SQL API, so Catalyst plans it and Tungsten executes it.  The
package is organised as:

* ``sources``   - readers, writers, the driver-table adapter, schema registry
* ``functions`` - reusable Column expressions (rounding, safe ratios, dates,
                  display formats)
* ``operators`` - cleaning, feature builders, marts, measures
* ``plans``     - dashboard queries, ML feature frames, models, metrics and the
                  query catalog used by ``__spark_entry__``
* ``streaming`` - incremental refresh of the marts from a landing folder
"""

__version__ = "0.1.0"
