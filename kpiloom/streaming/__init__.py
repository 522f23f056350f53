"""Streaming.

The KPI models are batch only: every mart is a full refresh over the whole
source tables at an explicit as-of date, and no operator keeps state between
runs, uses watermarks or reads an unbounded source.  Nothing is built here; a
streaming variant would be a new operator the marts do not have.
"""
