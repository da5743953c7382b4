"""Readers of raw deliveries, as numbered lines, parsed records or objects of foreign formats."""
