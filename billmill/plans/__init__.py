"""Compositions of the operators: staging, star schema, contract tables, whole run."""
