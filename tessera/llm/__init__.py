"""Operators for preparing text collections; nothing else in the library
imports this subpackage."""
