from silverlode.operators.normalize import core_movies, fill_defaults, normalize, normalize_marked, rejected

__all__ = ["core_movies", "fill_defaults", "normalize", "normalize_marked", "rejected"]
