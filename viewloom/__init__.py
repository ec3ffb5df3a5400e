"""viewloom: warehouse-migration analytics as PySpark DataFrame operators.

Sub-packages
------------
``functions``  Column helpers (the scalar vocabulary of calculation views, text columns, scores)
``operators``  DataFrame -> DataFrame operators (view nodes, joins, ordered scans, lineage, text jobs)
``sources``    readers, catalog harvest and writers
``plans``      the composite business queries
``queries``    every operator applied to the test tables, next to the SQL it must agree with
"""

__version__ = "0.1.0"
