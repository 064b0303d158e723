"""Operators for preparing training data, each usable alone; nothing outside this subpackage imports them."""
