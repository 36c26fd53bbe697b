"""Whole calculations: studies, member plans and the command line."""
