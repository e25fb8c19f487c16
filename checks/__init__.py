"""Independent SQL for checking the engine's queries."""
