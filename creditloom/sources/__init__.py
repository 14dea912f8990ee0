from creditloom.sources.feeds import feed_format, read_feed, read_key_list
from creditloom.sources.star_schema import star_feeds

__all__ = ["feed_format", "read_feed", "read_key_list", "star_feeds"]
