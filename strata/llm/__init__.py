"""Operators of a training-data pipeline; each module names its method.

Nothing else in the package imports this one, so it can be left out of an installation.
"""
