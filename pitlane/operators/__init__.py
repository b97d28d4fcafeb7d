"""DataFrame -> DataFrame operators: cleaning, series windows, profiles, unions."""
