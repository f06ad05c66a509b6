"""webcorpus: turn stored web pages and raw comment feeds into a queryable article corpus.

Every operator takes and returns DataFrames; nothing here holds a global session.
"""
