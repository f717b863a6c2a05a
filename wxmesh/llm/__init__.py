"""Operators for preparing training text: one module per operator.

Nothing outside this subpackage imports it. Their queries are in
``wxmesh.llm.queries``; ``corpus_pipeline.py`` at the repository top chains five
of them.
"""
