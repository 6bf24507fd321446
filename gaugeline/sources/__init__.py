"""Reading and writing: landing envelopes, tables, keyed merges."""
