"""Record-level operators: filters, de-duplication, template definitions, acquisition manifest."""
