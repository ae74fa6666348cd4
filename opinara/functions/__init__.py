"""Column expressions: tokens, vocabulary look-ups, sentiment, language, email headers, batch keys."""
