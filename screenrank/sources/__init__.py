from screenrank.sources.tables import read_table, conform  # noqa: F401
from screenrank.sources.text import (  # noqa: F401
    load_movies, load_ratings, load_tags, parse_rating_messages, render_rating_messages,
    parse_recent_entries,
)
