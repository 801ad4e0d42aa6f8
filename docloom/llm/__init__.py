"""Training-data operators: thirteen dealt methods and their registered queries. Nothing else in the library imports this package."""
