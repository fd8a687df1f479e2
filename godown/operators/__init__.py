"""Reusable DataFrame operators (distributed prefix sums, stock replay, interval sums, scope)."""
