"""barworks: market-data quality and analytics as Spark DataFrame operators.

Every operator takes and returns DataFrames keyed by ``symbol`` so one Spark
job handles every symbol at once.  Sub-packages:

* ``sources``   - table readers, the fixture mappings and the sinks (S*)
* ``functions`` - Column helpers and segmented series windows
* ``operators`` - shaping (P*), checks (V*, T*), cleaning (C*), joins (J*),
                  aggregates and views (A*, W*), reports
* ``streaming`` - quote intake and streaming aggregates (K*)
* ``plans``     - the registered queries and their SQL oracles
"""

__version__ = "0.1.0"
