"""Whole-layer builds (silver, gold, daily jobs) and the driver-table analogues."""
