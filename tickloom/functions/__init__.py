"""Column expressions: intervals, sessions, number coercion, eligibility rules, compensated sums."""
