"""Fixed dimension tables: tool catalog, trace templates, task families."""
