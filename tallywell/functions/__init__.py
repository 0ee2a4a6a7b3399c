"""Column expressions: typing of answers, ordinals, text and term lists."""
