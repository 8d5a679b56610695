"""Part of terraloom; see the modules of this package."""
