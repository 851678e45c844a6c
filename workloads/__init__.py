"""Queries over the TPC-H-like test tables that exercise every operator, with SQL oracles."""
