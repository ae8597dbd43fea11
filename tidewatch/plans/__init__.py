"""Queries over the tables of a data folder, and the SQL that must give the same rows."""
