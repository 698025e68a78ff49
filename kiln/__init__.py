"""kiln: ready-made analytics operators on Spark DataFrames.

Four families, every operator a lazy DataFrame-in / DataFrame-out function:

* web-log ETL and reporting      -> :mod:`kiln.operators.weblog`
* ratings and recommendation     -> :mod:`kiln.operators.ratings`, :mod:`kiln.operators.recommend`
* iterative graph analytics      -> :mod:`kiln.operators.graph`
* keyed / partition / sort basics -> :mod:`kiln.operators.keyed`

Sources and sinks live in :mod:`kiln.sources`, column-expression helpers in
:mod:`kiln.functions` and the named queries over the test tables in
:mod:`kiln.plans`.
"""

__version__ = "0.1.0"
