"""Real-estate and territory analytics as Spark DataFrame operators.

``functions`` holds Column builders, ``operators`` DataFrame-to-DataFrame jobs,
``sources`` readers and writers, ``plans`` the assembled reports, exports and
the queries that exercise all of it over the test tables.
"""
