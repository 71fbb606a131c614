"""Panels and journeys: what the shop asks of its landed tables."""
