"""wardmill: cleaning, contracting, star-splitting and auditing of admission records on Spark."""
