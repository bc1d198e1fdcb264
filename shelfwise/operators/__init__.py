"""DataFrame -> DataFrame operators (cleaning, features, quality, profiles)."""
