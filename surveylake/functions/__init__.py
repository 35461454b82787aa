"""Column functions: every one is a built-in Spark expression, none is a UDF."""

from surveylake.functions.convert import from_map, to_date, to_flag, to_int, to_money
from surveylake.functions.multi import join_list, list_size, split_list
from surveylake.functions.text import is_missing_word, key_of, standard, text_key, tidy

__all__ = [
    "from_map", "is_missing_word", "join_list", "key_of", "list_size", "split_list", "standard",
    "text_key", "tidy", "to_date", "to_flag", "to_int", "to_money",
]
