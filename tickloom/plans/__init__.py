"""Whole plans: snapshots of any number of frequencies, conversion, and the driver's queries."""
