"""Training-data operators: ten stages a text corpus passes before it is trained on.

Nothing outside this subpackage imports it; ``queries`` and ``oracle_sql`` live in
``framewright.llm.registry``.
"""
