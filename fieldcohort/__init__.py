"""Program-monitoring analytics as plain DataFrame transformations.

Layout: ``sources`` (readers and writers), ``functions`` (column functions),
``operators`` (table transformations), ``plans`` (cohort and KPI queries),
``streaming`` (incremental jobs), ``catalog`` (every query on the test tables,
next to the SQL it is checked against).
"""
