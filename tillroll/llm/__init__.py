"""Training-data pipeline operators (token counts, deduplication, extraction,
classifiers, search, archives). Nothing else in the library imports this
subpackage; the driver entry point adds its queries when it can be imported."""
