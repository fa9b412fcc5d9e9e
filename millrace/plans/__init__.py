"""Clean views, the star schema and the holiday model, composed from the operators."""
