"""Registered queries."""
