"""Generic table operators that hold up when one key owns a third of the rows."""
