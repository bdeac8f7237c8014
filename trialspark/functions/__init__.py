"""Column expressions: probability, scoring, cleaning, text and geography."""
