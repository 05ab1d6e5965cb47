"""Operators for preparing training text: ten document-corpus operators and
the pipeline made of five of them.  Nothing outside this folder imports it."""
