"""rollcall: Spark-native cleaning and publication of beneficiary registries.

Layers, lowest first:

* ``functions``  Column -> Column cleaners, native Catalyst expressions only
* ``operators``  DataFrame -> DataFrame joins, rules, nesting, reshaping, checks
* ``sources`` / ``sinks``  registry files, dimensions, partitioned tables, documents
* ``plans``      the composed pipelines
* ``streaming``  the same pipeline over files as they arrive
"""
