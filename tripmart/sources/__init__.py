"""Landing files, tables and scratch folders."""
