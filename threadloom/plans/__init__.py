"""Threadloom plans."""
