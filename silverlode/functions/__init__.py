from silverlode.functions.text import blank_null_words, quoted, typed

__all__ = ["blank_null_words", "quoted", "typed"]
