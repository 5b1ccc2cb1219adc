"""chatloom: chat-workspace exports to import-ready records, as Spark jobs."""
