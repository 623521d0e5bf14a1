"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it; its queries are registered from
``__spark_entry__`` only when the subpackage is present.
"""
