"""Training-data operators: formatting, privacy, filtering, sharding, tokens,
search, de-duplication, decontamination and language.

Each module is one operator with its own general interface; ``queries`` holds
the thin registered queries over the test tables. Nothing else in the library
imports this subpackage.
"""
