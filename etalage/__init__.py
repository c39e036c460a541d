"""etalage: retail price-and-stock analytics on a layered lakehouse, built on Spark.

Every step is a plain ``DataFrame -> DataFrame`` function; Catalyst plans it and
Spark runs it. Sub-packages:

* ``sources``   - reading source tables and layers, writing layers, test bindings
* ``functions`` - ``Column -> Column`` cleaners, hashing and date helpers
* ``operators`` - reusable relational operators (dedup, global rank, series fill,
                  sales estimate, lookups, set operations, snapshot, data quality)
* ``plans``     - the models: four bronze feeds, dimensions and the sales fact
* ``streaming`` - incremental arrival of daily feed files (Structured Streaming)
"""

from etalage.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
