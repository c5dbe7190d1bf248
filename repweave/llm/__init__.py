"""Training-data operators: ten corpus operators that stand beside the survey engine.

Nothing else in the library imports this package.
"""
