"""Column expressions: cleaning helpers and the shared business rules."""
