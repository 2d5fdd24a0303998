"""Readers: XML corpora in two dialects, lists, vocabularies, memories and exports."""
