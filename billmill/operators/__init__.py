"""Steps from DataFrame to DataFrame, chained with ``.transform``."""
