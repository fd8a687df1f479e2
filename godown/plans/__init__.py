"""Query plans: dimensions, facts, features, marts, checks, metrics, model, KPIs and the query registry."""
