"""Reading and writing: envelopes, tables, watermarks and schema contracts."""
