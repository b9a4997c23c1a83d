"""Routing, binding, netting, merging, archiving and statistics over change events."""
