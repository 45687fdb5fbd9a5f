"""Batch jobs (K1-K8).  Each is ``python -m sparkrec.jobs.<name> --help``.

Inputs are either raw CSV (``--movies``/``--ratings``), processed Parquet
(``--processed``) or the driver's tables (``--sf-dir``, fixture A).  Outputs
are Parquet/CSV/JSON directories under ``--out`` (any Hadoop file system URI).
"""
