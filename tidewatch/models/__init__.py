"""The layers of the lakehouse: staging reads payloads, silver has a row per thing, gold answers questions."""
