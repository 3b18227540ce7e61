"""Training-data operators: one module per operator, shared helpers beside them.

Nothing outside this subpackage imports it except the guarded registration in
``__spark_entry__.py``; deleting it leaves the settlement library whole.
"""
