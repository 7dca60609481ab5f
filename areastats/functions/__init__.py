"""Column expressions: text, keys, numbers and activations."""
