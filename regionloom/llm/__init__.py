"""Operators for preparing language-model training corpora.

Nothing outside this subpackage imports it; the repository's query registry adds
its queries when the subpackage is present.
"""
