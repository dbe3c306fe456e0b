from postgrain.sources.readers import (
    open_posts,
    read_clean_csv,
    read_legacy_csv,
    read_posts,
    read_result,
    register_views,
)
from postgrain.sources.sinks import (
    load_bloom,
    save_bloom,
    save_clean_posts,
    save_result,
    stored,
    write_csv,
)

__all__ = [
    "load_bloom", "open_posts", "read_clean_csv", "read_legacy_csv", "read_posts", "read_result",
    "register_views", "save_bloom", "save_clean_posts", "save_result", "stored", "write_csv",
]
