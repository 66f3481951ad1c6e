"""locus: site selection over planar points, written as Spark DataFrame jobs.

Sub-packages:

* ``sources``   - point, region (GeoJSON) and run-log scans and sinks
* ``functions`` - column expressions: distances, nearest centre, polygon edges
* ``operators`` - K-Means, K-Center, choice of k, DBSCAN, geography, results
* ``plans``     - fixtures derived from the input tables and the query catalog
* ``streaming`` - the stateless labelling operator over a stream of points

No operator sets a master or creates a session; every one takes DataFrames
and parameters and returns DataFrames (or a small driver-side summary of at
most a few hundred rows, e.g. the centres of a fit).
"""

__version__ = "0.1.0"
