"""Training-data operators: ten numbered operators, their queries, nothing else imports them."""
