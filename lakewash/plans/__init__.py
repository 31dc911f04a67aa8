"""Whole jobs (``jobs``), the target tables they load (``targets``), the
command-line runner (``cli``), and the query catalog behind
``__spark_entry__`` (``catalog``, with its ``fixtures`` and DuckDB
``oracle`` forms)."""
