"""Column expressions: text cleaning, money, business rules, offer ids, dates."""
