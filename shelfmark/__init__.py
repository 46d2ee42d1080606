"""Retail analytics jobs written as plain DataFrame -> DataFrame functions."""
