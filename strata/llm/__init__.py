"""Operators of a training-data pipeline: search, mixing, sanitising, decontamination,
de-duplication, classifiers, language-model scores, revisit resolution, token counts.

Nothing else in the package imports this subpackage.
"""
