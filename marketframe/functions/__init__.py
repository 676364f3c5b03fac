"""Column expressions: row normalisation, time, notes, code maps and option pricing."""
