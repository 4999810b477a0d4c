"""Operators for preparing training data: texts, vectors and conversations at corpus scale.

Nothing else in the library imports this subpackage.
"""
