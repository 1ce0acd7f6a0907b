"""Session analytics and table reconciliation as Spark DataFrame transformations."""
