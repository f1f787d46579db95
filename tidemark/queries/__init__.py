"""Registered checks: each runs an operator over whole tables beside plain SQL."""
