"""Product analytics on Spark: raw events in, clean events and daily metric tables out."""
