"""DataFrame-to-DataFrame stages: validate, silver, gold, training set, chat text, tokens, reports."""
