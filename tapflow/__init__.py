"""Public-transport journeys from card taps, gate records and vehicle positions, on Spark."""
