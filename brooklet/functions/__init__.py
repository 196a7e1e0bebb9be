"""Column expressions: record checks, text fields, envelopes and schema texts."""
