"""cadenza: a PySpark-native music-trend and recommendation engine.

Every public operator is a ``DataFrame -> DataFrame`` function meant for
``df.transform(...)``.  Sub-packages:

* ``sources``   - readers and writers (landed JSON, CSV, Parquet lake,
                  warehouse tables, run-state table)
* ``functions`` - Catalyst column expressions and the few Arrow UDFs
* ``operators`` - relational building blocks (labels, feeds, matching,
                  enrichment, reports, recommender, tuning)
* ``plans``     - the registered queries over the driver tables
* ``streaming`` - Structured Streaming variant of the incremental load
"""

__version__ = "0.1.0"
