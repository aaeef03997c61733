"""Sources: files of pathway, ontology and annotation databases read into tables."""
