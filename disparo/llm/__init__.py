"""Operators for training-data preparation: one module per operator, plus their queries
(``catalogue``) and DuckDB oracles (``oracle``).  Nothing outside this package imports it."""
