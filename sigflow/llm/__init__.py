"""Operators for preparing training text. Nothing outside this subpackage
imports it; the queries are in ``sigflow.llm.queries``.

Shared conventions: every operator selects the columns it needs first, so
extra columns of any name cannot clash; a null text counts as empty; no
operator looks at a prefix of a text or leaves out rows.
"""
