"""Training-data operators: dedup, filtering, extraction, counting, mixing.

One module per operator; :mod:`tidecast.llm.queries` registers one query for
each.  Nothing else in the library imports this subpackage.
"""
