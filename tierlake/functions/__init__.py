"""Column, schema, naming and storage helpers shared by sources and operators."""
