"""Operators for preparing language-model training data.

Each module holds one operator with a general interface; ``queries.py`` binds
them to the tables of a folder. Nothing else in the library imports this
subpackage. Unless a module says otherwise: columns besides the named ones are
ignored (so clashing extra columns do no harm), a null text counts as empty,
repeated rows each get their own result row, and an empty input gives an
empty result with the same schema.
"""
