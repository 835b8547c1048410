"""No streaming operators.

Publishers revise old months without notice, so every run is a full rebuild.
Nothing in the data model is an event stream, and none is invented here.
"""
