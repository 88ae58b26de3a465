"""Topics, tables and map layers."""
