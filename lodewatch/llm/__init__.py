"""Operators for preparing training text: rules, duplicates, secrets, chat logs, mixing and tokens.

Each module is one operator on frames; `queries` registers one query per operator, and
`corpus_pipeline.py` at the top of the repository chains five of them. Nothing outside this package imports it.
"""
