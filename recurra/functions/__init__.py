"""Column expressions: calendar keys, money, pricing rules."""
