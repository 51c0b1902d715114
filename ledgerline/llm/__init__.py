"""Training-data pipeline operators.

Nothing outside this subpackage imports it; the folder can be removed without
touching the rest of the library.
"""
