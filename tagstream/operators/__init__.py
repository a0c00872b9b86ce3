"""Operators: each is ``f(DataFrame, ...) -> DataFrame`` of native expressions."""
