"""Operators for preparing large training corpora. Nothing else in the library
imports this subpackage; its registered queries are in ``queries``."""
