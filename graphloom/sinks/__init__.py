"""Writers and text serialisations."""
