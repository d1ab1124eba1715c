"""Training-data operators: ten corpus operations that run as Spark jobs.

Nothing outside this subpackage imports it; ``queries.py`` holds the registered queries.
"""
