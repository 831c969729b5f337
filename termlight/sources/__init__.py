"""Readers and writers for collections, judgments, runs and reports."""
