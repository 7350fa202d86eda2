"""hourglass: relate point-in-time incidents to hourly or daily context on Spark.

Sub-packages:

* ``sources``   - readers and writers (S1-S8)
* ``functions`` - column expressions (X*, J2, J3, C1-C9)
* ``operators`` - DataFrame -> DataFrame operators (cleaning, profiling, filters,
  joins, aggregates, ordering, sampling, scaling, models)
* ``plans``     - end-to-end analyses (Q1-Q7) and the look-alike views used in checks
* ``streaming`` - placeholder; the source project has no streaming work
"""

__version__ = "0.1.0"
