"""Job parameters that change results, with their allowed ranges."""

from __future__ import annotations

from dataclasses import dataclass

# Default file endings that are never followed.
SKIP_EXTENSIONS = (
    ".jpg,.jpeg,.png,.gif,.bmp,.svg,.webp,.ico,.zip,.ods,.odt,.xls,"
    ".p7m,.rar,.mp3,.xml,.7z,.exe,.doc,.m4a,.crdownload,.odp,.ppt,.pptx"
)


@dataclass(frozen=True)
class Params:
    user_agent: str = "WebtideBot/1.0"
    max_depth: int = -1
    max_pages: int = -1
    skip_get_params: bool = False
    ingest_pdf: bool = False
    skip_extensions: str = SKIP_EXTENSIONS
    cache_content: bool = True
    follow_robots_txt: bool = True
    obey_crawl_delay: bool = True
    request_delay: float = 0.5
    use_sitemap: bool = True
    only_sitemap: bool = False
    scope_sitemap: bool = False
    chunk_size: int = 1024
    chunk_overlap: int = 256
    ignore_display_none: bool = False
    min_chunk_length: int = 50
    remove_delay: int = 0
    stale_in_sites: bool = False
    retry_failed_urls: bool = True
    max_retry_attempts: int = 3
    batch_size: int = 50
    adaptive_backoff: bool = True
    backoff_initial_seconds: float = 10.0
    backoff_max_seconds: float = 120.0
    backoff_threshold: int = 3

    def __post_init__(self) -> None:
        if self.chunk_size < 1 or not 0 <= self.chunk_overlap < self.chunk_size:
            raise ValueError("need 0 <= chunk_overlap < chunk_size")
        if self.remove_delay < 0:
            raise ValueError("remove_delay must be >= 0")
        if not 1 <= self.max_retry_attempts <= 10:
            raise ValueError("max_retry_attempts must be in 1..10")
        if not 1 <= self.batch_size <= 1000:
            raise ValueError("batch_size must be in 1..1000")
        if self.max_depth < -1 or self.max_pages < -1:
            raise ValueError("max_depth and max_pages must be -1 (off) or more")
