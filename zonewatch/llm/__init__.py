"""Operators of a training-data pipeline, each with its query in ``queries``.

Nothing outside this package imports it; the driver contract adds its queries
only where the package is present.
"""
