"""Training-data operators. Nothing else in folioframe imports this subpackage."""
