"""The named operators: tables in, a table out."""
