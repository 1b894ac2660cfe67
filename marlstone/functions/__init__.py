"""Column -> Column helpers. Built-in expressions only, so they stay in codegen."""
