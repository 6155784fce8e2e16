"""Operators for preparing training text at scale, one module each.

``queries.py`` registers one query per operator, ``sql.py`` the same questions
as DuckDB SQL. Nothing outside this package imports it.
"""
