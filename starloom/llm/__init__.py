"""Training-data operators: search, filters, mixing, token output, dedup.

Each module holds one operator with its own general interface;
``starloom.llm.queries`` registers one thin query per operator.  Nothing
outside this subpackage imports it.
"""
