"""Pure Column -> Column expressions."""
