"""Operators for preparing training data; nothing else in the library uses them.

Every operator is a function from DataFrame to DataFrame.  ``queries`` applies
each of them to a whole table, and ``oracle`` holds the SQL they must agree with.
"""
