"""Readers and writers of the Bronze, Silver and Gold layers."""
