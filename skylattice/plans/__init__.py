"""Whole flows over the flight, weather, station and airport tables."""
