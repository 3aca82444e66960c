"""Logical plans: silver, decisions, gold, marketplace, replay, serving, checks."""
