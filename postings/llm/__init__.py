"""Training-data operators: near copies, repeated passages, scoring, mixing and token output.

Nothing outside this subpackage imports it; ``queries.register`` is the only hook the
entry module uses, and only when the subpackage is present.
"""
