"""Registered queries (``QUERIES``) and their SQL oracles (``ORACLE``)."""
