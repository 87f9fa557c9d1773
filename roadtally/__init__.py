"""Hourly sensor counts on a network: cleaning, features, hotspots, routes, layers.

Every operator is a function from DataFrames to a DataFrame.  The library never
creates a session and never sets a master; the caller's session decides both.
"""
