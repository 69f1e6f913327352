"""weirflow: document enrichment and corpus preparation as Spark plans."""
