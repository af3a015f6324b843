"""Reusable plan shapes: written intermediates, exact ordering, checked lookups."""
