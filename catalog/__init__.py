"""Registered queries: every operator run over the given tables, with its SQL twin."""
