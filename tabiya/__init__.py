"""tabiya — repertoire analytics as Spark DataFrame operators.

Every public operator is a function ``DataFrame -> DataFrame`` built from
Spark SQL expressions, windows, joins and aggregations, so Catalyst can push
filters and prune columns down to the scans and AQE can re-plan shuffles at
run time.
"""

__version__ = "0.1.0"
