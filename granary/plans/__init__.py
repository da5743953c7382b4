"""Whole builds: raw collections to validated tables, and tables to selected, encoded chunks."""
