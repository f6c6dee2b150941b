"""Training-data operators: dedup, decontamination, language, toxicity, tokens, quality.

Self-contained: nothing else in the library imports this subpackage.
"""
