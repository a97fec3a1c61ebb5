"""Tripmart: a Spark-native analytics engine for shared-mobility data.

Layers, from the bottom up:

* ``functions``  column expressions (cleaning, safe casts, rounding, geography)
* ``operators``  generic DataFrame operators (de-duplicate, latest, peak, previous, share ...)
* ``sources``    schemas, readers and writers
* ``streaming``  validation, quarantine and the streaming twins of the event marts
* ``plans``      the domain: staging dimensions, cleaned facts, marts, quality checks
* ``showcase``   the same plans over the supplied test tables, with SQL oracles
"""
