"""Training-data operators over texts. Nothing else in the library imports this subpackage."""
