"""Column expressions: text, vectors, guards, prompts, chat."""
