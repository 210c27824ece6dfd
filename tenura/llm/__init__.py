"""Operators for cleaning training corpora; each works on any DataFrame with the named columns."""
