"""Threadloom streaming."""
