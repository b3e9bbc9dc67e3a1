"""The available test tables in the shapes of the incident data."""
