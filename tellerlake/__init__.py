"""tellerlake: a layered retail-banking warehouse as plain Spark DataFrames.

Operators take DataFrames and return DataFrames; reading and writing happen
only in ``sources`` and ``streaming``, and ``plans`` strings the steps together.
"""
