"""Registered queries: every operator run over the given tables, with the SQL it has to agree with."""
