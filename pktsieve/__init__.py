"""pktsieve: packet classification with pre-trained models, as Spark jobs."""
