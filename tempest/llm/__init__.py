"""Operators for building training data: token counts, packing, near duplicates, quality, toxicity,
decontamination, language-model scores, licences and chat rendering.

Nothing else in the library imports this subpackage. Each operator module has a general function over
DataFrames and the thin registered query ``opN_<name>(spark, sf_dir)``; ``queries.py`` collects them.
"""
