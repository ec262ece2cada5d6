"""Query plans: bind the driver's tables to the library's operators.

Each domain module exports ``QUERIES`` (key -> callable(spark, sf_dir)) and
``ORACLE`` (key -> DuckDB SQL computing the same rows).
"""
