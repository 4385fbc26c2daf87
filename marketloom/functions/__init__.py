"""Column helpers and small distributed building blocks the operators share."""
