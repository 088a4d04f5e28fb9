"""Operators for preparing training data at corpus scale.

Each module holds one operator with a general interface (DataFrame in,
DataFrame out); :mod:`plumage.llm.queries` registers the thin queries over the
driver's tables. Nothing outside this subpackage imports it.
"""
