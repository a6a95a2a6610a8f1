"""Operators: free functions ``op(df, ...) -> DataFrame`` and a few fitted models."""
