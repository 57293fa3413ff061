"""Training-data operators: thirteen corpus operators, their queries and their SQL.

Nothing outside this subpackage imports it.
"""
