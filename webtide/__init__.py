"""Keep a text corpus in step with a captured set of web pages, as Spark jobs."""
