"""Operators: each is ``f(df, ...) -> DataFrame``, lazy, usable through ``df.transform``."""
