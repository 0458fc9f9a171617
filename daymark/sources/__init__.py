"""Tables in and out: schemas, readers, writers and storage layout."""
