"""Column expressions: tokenizer and scoring formulas."""
