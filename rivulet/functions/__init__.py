from rivulet.functions.text import (
    append_suffix, composite_key, event_message, page_links, page_title,
    regex_number, split_words,
)
from rivulet.functions.records import hour_of_day, parse_stock_line, stock_watch

__all__ = [
    "append_suffix", "composite_key", "event_message", "page_links",
    "page_title", "regex_number", "split_words", "hour_of_day",
    "parse_stock_line", "stock_watch",
]
