"""Readers of raw tables and writers of cleaned tables and reports."""
