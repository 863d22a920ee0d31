"""Layered order analytics as plain DataFrame-to-DataFrame functions."""
