"""Column functions: text, URLs, identities, time, term lists."""
