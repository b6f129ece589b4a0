"""Document analytics on Spark: line tables, layout and text features, rules, alignment, registries, vectors."""
